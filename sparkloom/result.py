"""Results: a cursor over rows or Arrow batches, strict typed access, and tables as text."""

from __future__ import annotations

import contextlib
import dataclasses
import types
import typing
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row
from pyspark.sql.pandas.types import to_arrow_schema


class ResultError(Exception):
    """An error of a statement, with its kind."""

    def __init__(self, message: str, kind: str):
        super().__init__(message)
        self.kind = kind


#: Beginnings of Spark's error conditions and the kinds of errors they stand for.
KINDS = (
    ("PARSE", "parser"), ("TABLE_OR_VIEW_NOT_FOUND", "catalog"), ("SCHEMA_NOT_FOUND", "catalog"), ("UNRESOLVED_ROUTINE", "catalog"), ("TABLE_OR_VIEW_ALREADY_EXISTS", "catalog"),
    ("UNRESOLVED", "binder"), ("DATATYPE_MISMATCH", "binder"), ("WRONG_NUM_ARGS", "binder"), ("UNBOUND_SQL_PARAMETER", "binder"), ("DIVIDE_BY_ZERO", "out of range"),
    ("ARITHMETIC_OVERFLOW", "out of range"), ("NUMERIC_VALUE_OUT_OF_RANGE", "out of range"), ("CAST", "conversion"), ("PATH_NOT_FOUND", "io"), ("UNSUPPORTED", "not implemented"),
)


@contextlib.contextmanager
def translated():
    try:
        yield
    except PySparkException as e:
        condition = e.getCondition() or ""
        raise ResultError(str(e), next((k for start, k in KINDS if condition.startswith(start)), "invalid")) from e


def decode(value: Any, kind: Any, where: str = "value") -> Any:
    """value as the annotated type; null only where the type allows None, and no silent conversion."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (typing.Union, types.UnionType):
        if value is None and type(None) in args:
            return None
        for k in (a for a in args if a is not type(None)):
            with contextlib.suppress(TypeError):
                return decode(value, k, where)
        raise TypeError(f"{where} is no {kind}")
    if kind is Any:
        return value
    if value is None:
        raise TypeError(f"{where} is null; use {getattr(kind, '__name__', kind)} | None")
    if origin is list:
        return [decode(v, args[0], f"{where}[{i}]") for i, v in enumerate(value)]
    if origin is dict:
        return {decode(k, args[0], where): decode(v, args[1], f"{where}[{k!r}]") for k, v in (value.items() if isinstance(value, dict) else value)}
    if origin is tuple:
        if len(args) != len(value):
            raise TypeError(f"{where} has {len(value)} columns, not {len(args)}")
        return tuple(decode(v, k, f"{where}[{i}]") for i, (v, k) in enumerate(zip(value, args, strict=True)))
    if dataclasses.is_dataclass(kind):
        fields, hints = dataclasses.fields(kind), typing.get_type_hints(kind)
        values = list(value.values()) if isinstance(value, dict) else list(value)
        if len(fields) != len(values):
            raise TypeError(f"{where} has {len(values)} columns, not {len(fields)}")
        return kind(*(decode(v, hints[f.name], f"{where}.{f.name}") for v, f in zip(values, fields, strict=True)))
    if not isinstance(value, kind) or (isinstance(value, bool) and kind is not bool):
        raise TypeError(f"{where} is {type(value).__name__}, not {kind.__name__}")
    return value


def _plain(value: Any) -> Any:
    """Rows within a value as dictionaries, maps as pairs."""
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return [(_plain(k), _plain(v)) for k, v in value.items()]
    return [_plain(v) for v in value] if isinstance(value, list) else value


class Result:
    """A query's rows, fetched forward by one shared cursor; the DataFrame stays lazy until then."""

    def __init__(self, df: DataFrame, statement_type: str = "select"):
        self.df, self.statement_type, self._rows = df, statement_type, None
        #: Rows that an INSERT has added; 0 for other statements.
        self.rows_changed = 0

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    @property
    def types(self) -> list[str]:
        return [f.dataType.simpleString() for f in self.df.schema]

    @property
    def description(self) -> list[tuple[int, str, str]]:
        return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(self.df.schema)]

    def __iter__(self) -> Iterator[Row]:
        if self._rows is None:
            self._rows = self.df.toLocalIterator(prefetchPartitions=True)
        while True:
            with translated():
                row = next(self._rows, None)
            if row is None:
                return
            yield row

    def fetchone(self, kind: Any = None):
        row = next(iter(self), None)
        return row if row is None or kind is None else decode(row, kind, "row")

    def fetchmany(self, n: int = 1, kind: Any = None) -> list:
        out = []
        while len(out) < n and (row := self.fetchone(kind)) is not None:
            out.append(row)
        return out

    def chunks(self, size: int = 2048) -> Iterator[pa.RecordBatch]:
        """The rows not fetched yet as Arrow batches of at most size rows, partition by partition, never all at once."""
        schema = to_arrow_schema(self.df.schema)
        while rows := self.fetchmany(size):
            yield pa.RecordBatch.from_arrays([pa.array([_plain(r[i]) for r in rows], f.type) for i, f in enumerate(schema)], schema=pa.schema([f.with_nullable(True) for f in schema]))

    def fetchall(self) -> Materialized:
        with translated():
            return Materialized(self.df.toArrow())

    def show(self, max_rows: int = 40) -> str:
        """A box of the rows: all if there are no more than max_rows + 3, else the first and last of max_rows."""
        return self.fetchall().show(max_rows)


class Materialized:
    """All rows held as an Arrow table, with access by row and column and batch by batch."""

    def __init__(self, table: pa.Table):
        self.table = table

    def __len__(self) -> int:
        return self.table.num_rows

    def chunks(self) -> list[pa.RecordBatch]:
        return self.table.to_batches()

    def get(self, row: int, column: int | str, kind: Any = Any) -> Any:
        if not 0 <= row < len(self):
            raise IndexError(row)
        return decode(self.table.column(column)[row].as_py(), kind, f"{column}")

    def column(self, column: int | str, kind: Any = Any) -> list:
        return [decode(v, kind, f"{column}[{i}]") for i, v in enumerate(self.table.column(column).to_pylist())]

    def is_null(self, column: int | str, row: int | None = None) -> bool:
        """Of a cell; of a column whether all its cells are null."""
        c = self.table.column(column)
        return c.null_count == len(c) if row is None else not c[row].is_valid

    def rows(self, kind: Any = Any) -> list:
        columns = [c.to_pylist() for c in self.table.columns]
        return [decode(r, kind, f"row {i}") for i, r in enumerate(zip(*columns, strict=True))]

    def show(self, max_rows: int = 40) -> str:
        n, half = len(self), max_rows // 2
        cut = n > max_rows + 3
        at = [*range(half), *range(n - (max_rows - half), n)] if cut else range(n)
        names, kinds = self.table.column_names, [str(t) for t in self.table.schema.types]
        body = [["" if (v := c[i].as_py()) is None else str(v) for c in self.table.columns] for i in at]
        if cut:
            body[half:half] = [["·"] * len(names)] * 3
        width = [max(len(x) for x in [a, b, *(r[i] for r in body)]) for i, (a, b) in enumerate(zip(names, kinds, strict=True))]
        right = [pa.types.is_integer(t) or pa.types.is_floating(t) or pa.types.is_decimal(t) for t in self.table.schema.types]
        line = lambda a, b, c: a + b.join("─" * (w + 2) for w in width) + c
        cells = lambda r, f: "│" + "│".join(f" {f(x, w, k)} " for x, w, k in zip(r, width, right, strict=True)) + "│"
        middle = lambda x, w, _: x.center(w)
        put = lambda x, w, k: x.rjust(w) if k else x.ljust(w)
        out = [line("┌", "┬", "┐"), cells(names, middle), cells(kinds, middle), line("├", "┼", "┤"), *(cells(r, put) for r in body), line("└", "┴", "┘")]
        return "\n".join([*out, f"{n} rows ({max_rows} shown)"] if cut else out)
