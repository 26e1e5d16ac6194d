"""Joins that Spark has no single operator for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: list[str], time: str, value: str, bucket: str | None = None) -> DataFrame:
    """left with the value of the right side's last row at or before its own time, null if there is none or that value is null.

    Both sides are put in one order per key and the value is carried forward by a running window:
    one shuffle on the key, no pairs. With bucket (a date_trunc unit such as 'day') a key's rows
    are dealt out by time as well, and the last value of earlier buckets is carried over through a
    table of one row per key and bucket; use it where one key holds a large share of all rows.
    """
    # values in a struct, so that a row with a null value differs from no row
    b = right.select(*by, time, F.struct(F.col(value).alias("x")).alias("__v"), F.lit(0).alias("__side"))
    a = left.select(*left.columns, F.lit(None).cast(b.schema["__v"].dataType).alias("__v"), F.lit(1).alias("__side"))
    rows = a.unionByName(b, allowMissingColumns=True)
    if bucket is None:
        run = Window.partitionBy(*by).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("__in", F.last("__v", ignorenulls=True).over(run)).where("__side = 1").select(*left.columns, F.col("__in.x").alias(value))
    rows = rows.withColumn("__b", F.date_trunc(bucket, F.col(time)))
    run = Window.partitionBy(*by, "__b").orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumn("__in", F.last("__v", ignorenulls=True).over(run)).where("__side = 1")
    ends = b.withColumn("__b", F.date_trunc(bucket, F.col(time))).groupBy(*by, "__b").agg(F.max_by("__v", F.struct(time)).alias("__end"))
    seen = inner.select(*by, "__b").distinct().join(ends, [*by, "__b"], "full")
    before = seen.withColumn("__before", F.last("__end", ignorenulls=True).over(Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
    keyed = before.select(*[F.col(c).alias(f"__k_{c}") for c in by], F.col("__b").alias("__kb"), "__before")
    same = F.col("__b").eqNullSafe(F.col("__kb"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    return inner.join(keyed, same, "left").select(*left.columns, F.coalesce("__in", "__before")["x"].alias(value))


def in_range(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Pairs with low <= point < high. Ranges are cut into buckets of that width, so it is an equality join and no cross join; choose a width near the usual length."""
    p = points.withColumn("__k", F.floor(F.col(point) / width))
    r = ranges.withColumn("__k", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, "__k").where((F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))).drop("__k")
