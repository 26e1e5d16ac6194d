"""Readers of the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a dataset folder; the path may lie in any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
