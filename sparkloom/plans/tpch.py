"""Pricing summary, revenue forecast and promotion effect over the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table


def q1_pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 4).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
            F.round(F.sum(disc), 2).alias("sum_disc_price"),
            F.round(F.sum(disc * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
            F.round(F.avg("l_discount"), 8).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def q6_forecast_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year is 1996: the tables start in 1995."""
    return (
        table(spark, sf_dir, "lineitem")
        .where(
            (F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
            & F.col("l_discount").between(0.05, 0.07)
            & (F.col("l_quantity") < 24)
        )
        .agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4).alias("revenue"))
    )


def q14_promo_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").where(
        (F.col("l_shipdate") >= F.lit("1995-09-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1995-10-01").cast("timestamp_ntz"))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    promo = F.when(F.col("p_type").like("PROMO%"), revenue).otherwise(0.0)
    return line.join(part, line.l_partkey == part.p_partkey).agg(
        F.round(100.0 * F.sum(promo) / F.sum(revenue), 6).alias("promo_revenue")
    )


QUERIES = {
    "q1_pricing_summary": q1_pricing_summary,
    "q6_forecast_revenue": q6_forecast_revenue,
    "q14_promo_effect": q14_promo_effect,
}

ORACLE = {
    "q1_pricing_summary": """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 4) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
       round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS avg_price,
       round(avg(l_discount), 8) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL ORDER BY 1, 2""",
    "q6_forecast_revenue": """
SELECT round(sum(l_extendedprice * l_discount), 4) AS revenue FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
  AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
    "q14_promo_effect": """
SELECT round(100.0 * sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END)
       / sum(l_extendedprice * (1 - l_discount)), 6) AS promo_revenue
FROM lineitem, part WHERE l_partkey = p_partkey
  AND l_shipdate >= TIMESTAMP '1995-09-01' AND l_shipdate < TIMESTAMP '1995-10-01'""",
}
