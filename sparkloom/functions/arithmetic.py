"""A small extension of SQL functions: add_numbers, negate_number, multiply_numbers, triple. They are SQL bodies, so the optimizer sees through them."""

from __future__ import annotations

from pyspark.sql import SparkSession

API_LEVEL = 1
_BODIES = {"add_numbers(a BIGINT, b BIGINT)": "a + b", "negate_number(a BIGINT)": "-a", "multiply_numbers(a DOUBLE, b DOUBLE)": "a * b", "triple(a BIGINT)": "3 * a"}


def register(spark: SparkSession) -> None:
    for head, body in _BODIES.items():
        kind = "DOUBLE" if "DOUBLE" in head else "BIGINT"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
