"""User table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@udtf
class Counter:
    """counter(n, start => 0): n integers from start."""

    @staticmethod
    def analyze(n: AnalyzeArgument, start: AnalyzeArgument | None = None) -> AnalyzeResult:
        return AnalyzeResult(StructType().add("i", LongType()))

    def eval(self, n: int, start: int = 0):
        for i in range(n or 0):
            yield (start + i,)


@udtf(returnType=StructType().add("id", IntegerType()).add("name", StringType()).add("score", DoubleType()))
class MultiColumn:
    """multi_col(): three fixed rows."""

    def eval(self):
        for i, name in enumerate(("alice", "bob", "carol")):
            yield i + 1, name, 10.5 * i


def counter(spark: SparkSession, n: int, start: int = 0) -> DataFrame:
    """The same rows as counter, made natively and in parallel."""
    return spark.range(start, start + n).withColumnRenamed("id", "i")


def register(spark: SparkSession) -> None:
    spark.udtf.register("counter", Counter)
    spark.udtf.register("multi_col", MultiColumn)
