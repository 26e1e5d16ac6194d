"""Bulk loading: rows are gathered in columns and appended as one file set at each flush."""

from __future__ import annotations

import dataclasses
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_schema


class Appender:
    """Loads a table row by row. Rows are seen by others after flush or close; leaving a with block closes it."""

    def __init__(self, spark: SparkSession, table: str, flush_rows: int = 100_000):
        if not spark.catalog.tableExists(table):
            raise ValueError(f"there is no table {table}")
        self.spark, self.name, self.flush_rows = spark, table, flush_rows
        self.schema = spark.table(table).schema
        self.columns: list[list[Any]] = [[] for _ in self.schema]
        self.row: list[Any] | None = None

    def begin_row(self) -> None:
        if self.row is not None:
            raise ValueError("the row before has not ended")
        self.row = []

    def append(self, value: Any) -> Appender:
        if self.row is None:
            self.row = []
        if len(self.row) == len(self.columns):
            raise ValueError(f"the table has {len(self.columns)} columns")
        self.row.append(value)
        return self

    def append_null(self) -> Appender:
        return self.append(None)

    def end_row(self) -> None:
        if self.row is None or len(self.row) != len(self.columns):
            raise ValueError(f"{len(self.row or [])} of {len(self.columns)} columns have a value")
        for c, v in zip(self.columns, self.row, strict=True):
            c.append(v)
        self.row = None
        if len(self.columns[0]) >= self.flush_rows:
            self.flush()

    def append_row(self, row: Any) -> None:
        """A sequence or a dataclass, by position."""
        values = [getattr(row, f.name) for f in dataclasses.fields(row)] if dataclasses.is_dataclass(row) else list(row)
        self.begin_row()
        for v in values:
            self.append(v)
        self.end_row()

    def append_rows(self, rows: Any) -> None:
        for row in rows:
            self.append_row(row)

    def flush(self) -> None:
        if self.columns and self.columns[0]:
            kinds = to_arrow_schema(self.schema)
            data = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, kinds, strict=True)], schema=pa.schema([f.with_nullable(True) for f in kinds]))
            self.spark.createDataFrame(data, self.schema).write.mode("append").insertInto(self.name)
            self.columns = [[] for _ in self.schema]

    def close(self) -> None:
        self.flush()

    def __enter__(self) -> Appender:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.close()
