"""User aggregates. Known reducers become native aggregates, which have a partial phase; others fold a group's values.

A user aggregate is a function from a Column to a Column, so it mixes with built-in aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

Reducer = Callable[[Column], Column]


def _ended(value: Column, kind: str, empty: str, init: Any) -> Column:
    value = value.cast(kind)
    if empty == "init":
        return F.coalesce(value, F.lit(init).cast(kind))
    if empty != "null":
        raise ValueError("empty must be 'null' or 'init'")
    return value


def from_sum(kind: str, empty: str = "null") -> Reducer:
    """Sum, cast to kind: a value beyond kind raises instead of wrapping. Without rows: null, or 0 for empty='init'."""
    return lambda c: _ended(F.sum(c), kind, empty, 0)


def from_product(kind: str, empty: str = "null") -> Reducer:
    return lambda c: _ended(F.product(c), kind, empty, 1)


def from_max(kind: str) -> Reducer:
    """NaN counts as the largest value."""
    return lambda c: F.max(c.cast(kind))


def from_min(kind: str) -> Reducer:
    return lambda c: F.min(c.cast(kind))


def from_mean(kind: str = "double") -> Reducer:
    """Computed in double whatever the input's type, cast at the end."""
    return lambda c: F.avg(c).cast(kind)


def from_reduce(merge: Callable[[Column, Column], Column], init: Any, kind: str, empty: str = "null") -> Reducer:
    """An associative and commutative merge of Columns with its identity; nulls are skipped.

    The group's values are collected and folded, so use it where groups are small; two_stage has a
    partial phase for large ones.
    """

    def run(c: Column) -> Column:
        folded = F.aggregate(F.collect_list(c.cast(kind)), F.lit(init).cast(kind), lambda a, x: merge(a, x).cast(kind))
        return _ended(F.when(F.count(c) > 0, folded), kind, empty, init)

    return run


def two_stage(df: DataFrame, by: list[str], value: str, update: Callable[[Any, pa.Array], Any], combine: Callable[[Any, Any], Any], finish: Callable[[Any], Any], init: Any, state: str, result: str) -> DataFrame:
    """A user aggregate by callbacks with a partial phase: rows (by, value).

    update folds an Arrow array into a state, combine merges two states, finish ends. Each task sorts
    its rows by group and makes one state per group; only states are shuffled, and again sorted. A
    task holds one batch and one state at a time. state and result are SQL types.
    """
    partial_schema = df.select(*by, F.lit(None).cast(state).alias("state")).schema
    final_schema = df.select(*by, F.lit(None).cast(result).alias("value")).schema

    def folded(schema: StructType, name: str, fold: Callable[[Any, pa.Array], Any], end: Callable[[Any], Any]):
        kind = to_arrow_type(schema[-1].dataType)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, total = None, init
            for batch in batches:
                if not batch.num_rows:
                    continue
                *keys, values = batch.columns
                group = [k.slice(0, 1) for k in keys] if group is None else group
                rows = [pa.concat_arrays(x) for x in zip(group, keys, strict=True)]
                ends, made, at = _ends(rows, batch.num_rows), [], 0
                for b in ends:
                    made.append(end(fold(total, values.slice(at, b - at)) if b > at else total))
                    total, at = init, b
                total = fold(total, values.slice(at))
                yield pa.RecordBatch.from_arrays([*(r.take(pa.array(ends, pa.int64())) for r in rows), pa.array(made, kind)], names=[*by, name])
                group = [k.slice(batch.num_rows - 1) for k in keys]
            if group is not None:
                yield pa.RecordBatch.from_arrays([*group, pa.array([end(total)], kind)], names=[*by, name])

        return run

    def merged(total: Any, states: pa.Array) -> Any:
        return reduce(combine, states.to_pylist(), total)

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions(*by) if by else rows

    states = in_order(df.select(*by, value)).mapInArrow(folded(partial_schema, "state", update, lambda s: s), partial_schema)
    states = states.repartition(*by) if by else states.repartition(1)
    return in_order(states).mapInArrow(folded(final_schema, "value", merged, finish), final_schema)


def _ends(keys: list[pa.Array], n: int) -> list[int]:
    """Of n + 1 rows in order those, from 0, after which another group begins. As in a grouping, nulls are equal, and so are NaNs."""
    end = np.zeros(n, bool)
    for k in keys:
        a, b = k.slice(0, n), k.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(k.type):
            differ = pc.and_not(differ, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        end |= pc.or_(differ, pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    return np.flatnonzero(end).tolist()


class AggregateSet:
    """Overloads of one name, chosen by the argument's type."""

    def __init__(self, name: str):
        self.name, self.overloads = name, {}

    def add(self, kind: str, f: Reducer) -> AggregateSet:
        if kind in self.overloads:
            raise ValueError(f"{self.name} has an overload for {kind} already")
        self.overloads[kind] = f
        return self

    def on(self, df: DataFrame, column: str) -> Column:
        kind = df.schema[column].dataType.simpleString()
        if kind not in self.overloads:
            raise TypeError(f"{self.name} has no overload for {kind}")
        return self.overloads[kind](F.col(column))
