"""User scalar functions: as a Column expression where one exists, else in Arrow batches, else row by row with a guard for nulls."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def native(f: Callable[..., Column]) -> Callable[..., Column]:
    """An expression builder as a function; it stays in generated code."""

    @functools.wraps(f)
    def call(*args) -> Column:
        return f(*(a if isinstance(a, Column) else F.col(a) if isinstance(a, str) else F.lit(a) for a in args))

    return call


def batch(f: Callable, result: str):
    """A function of pandas Series (nulls reach it)."""
    return F.pandas_udf(f, result)


def row(f: Callable, result: str, special_nulls: bool = False, volatile: bool = False):
    """A function of single values; a null argument gives null unless special_nulls. volatile: not folded or repeated freely."""

    @functools.wraps(f)
    def guarded(*args):
        return None if not special_nulls and any(a is None for a in args) else f(*args)

    out = F.udf(guarded, result, useArrow=True)
    return out.asNondeterministic() if volatile else out


def register(spark: SparkSession, name: str, f) -> None:
    """Makes a batch or row function known to SQL; it lives as long as the session."""
    spark.udf.register(name, f)


class FunctionSet:
    """Overloads of one name, chosen by the types of the arguments in a DataFrame."""

    def __init__(self, name: str):
        self.name, self.overloads = name, {}

    def add(self, kinds: tuple[str, ...], f: Callable[..., Column]) -> FunctionSet:
        if kinds in self.overloads:
            raise ValueError(f"{self.name} has an overload for {kinds} already")
        self.overloads[kinds] = f
        return self

    def on(self, df: DataFrame, *columns: str) -> Column:
        kinds = tuple(df.schema[c].dataType.simpleString() for c in columns)
        if kinds not in self.overloads:
            raise TypeError(f"{self.name} has no overload for {kinds}")
        return self.overloads[kinds](*map(F.col, columns))
