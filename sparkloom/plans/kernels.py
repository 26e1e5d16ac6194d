"""Math, reduction and arithmetic kernels over lineitem, all as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import aggregate as agg
from ..functions.replace import Replacements
from ..sources.tables import table

def x() -> Column:
    return F.col("l_extendedprice") / 1000 + 0.01


def y() -> Column:
    return F.col("l_quantity") + 0.01


_SX, _SY = "(l_extendedprice / 1000 + 0.01)", "(l_quantity + 0.01)"

#: Name, expression, the same in SQL.
MATH = {
    "sqrt": (lambda: F.sqrt(x()), f"sqrt({_SX})"),
    "sin": (lambda: F.sin(x()), f"sin({_SX})"),
    "cos": (lambda: F.cos(x()), f"cos({_SX})"),
    "exp": (lambda: F.exp(-x() / 100), f"exp(-{_SX} / 100)"),
    "ln": (lambda: F.log(x()), f"ln({_SX})"),
    "abs": (lambda: F.abs(x() - 50), f"abs({_SX} - 50)"),
    "sin_plus_cos": (lambda: F.sin(x()) + F.cos(x()), f"sin({_SX}) + cos({_SX})"),
    "hypot1": (lambda: F.sqrt(x() * x() + 1), f"sqrt({_SX} * {_SX} + 1)"),
    "gauss": (lambda: F.exp(-(x() * x()) / 10000), f"exp(-({_SX} * {_SX}) / 10000)"),
    "hypot": (lambda: F.hypot(x(), y()), f"sqrt({_SX} * {_SX} + {_SY} * {_SY})"),
    "atan2": (lambda: F.atan2(x(), y()), f"atan2({_SX}, {_SY})"),
}



def disc() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


MICRO = {
    "disc_price": (disc, "l_extendedprice * (1 - l_discount)"),
    "charge": (lambda: disc() * (1 + F.col("l_tax")), "l_extendedprice * (1 - l_discount) * (1 + l_tax)"),
    "price_disc": (lambda: F.col("l_extendedprice") * F.col("l_discount"), "l_extendedprice * l_discount"),
}


def _summed(c: Callable[[], Column], digits: int):
    return lambda spark, sf_dir: table(spark, sf_dir, "lineitem").agg(F.round(F.sum(c()), digits).alias("total"))


def _reduced(f: agg.Reducer, by: str | None, where: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "lineitem")
        rows = rows if where is None else rows.where(where)
        out = F.round(f(F.col("l_quantity")), 6).alias("value")
        return rows.groupBy(by).agg(out) if by else rows.agg(out)

    return run


#: Aggregates built by the function kit, and their SQL.
REDUCERS = {
    "sum": (agg.from_sum("double"), "sum(l_quantity)"),
    "max": (agg.from_max("double"), "max(l_quantity)"),
    "min": (agg.from_min("double"), "min(l_quantity)"),
    "mean": (agg.from_mean("double"), "avg(l_quantity)"),
    "reduce_max": (agg.from_reduce(lambda a, b: F.greatest(a, b), float("-inf"), "double"), "max(l_quantity)"),
}
FEW = "l_orderkey < 8"
_FEW = "WHERE l_orderkey < 8"


def agg_reduce_max_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge by callbacks in two stages: no task and no row holds all values of a supplier. NaN counts as the largest value."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity"))

    def greatest(a: float | None, b: float | None) -> float | None:
        return b if a is None or b is not None and (b > a or b != b) else a

    def update(state: float | None, values: pa.Array) -> float | None:
        values = values.drop_null()
        return greatest(state, float(values.to_numpy().max())) if len(values) else state

    found = agg.two_stage(rows, ["l_suppkey"], "l_quantity", update, greatest, lambda state: state, None, "double", "double")
    return found.select("l_suppkey", F.round("value", 6).alias("value"))


def agg_product_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product over all rows, of factors so near 1 that it stays finite."""
    return table(spark, sf_dir, "lineitem").agg(F.round(agg.from_product("double")(1 + F.col("l_discount") / 1e6), 9).alias("value"))


def agg_product_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(agg.from_product("double")(F.col("l_quantity")).alias("value"))


def dec_mul_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal products kept to four places by rounding down, not to the nearest."""
    a, b = F.col("l_extendedprice").cast("decimal(15,2)"), (1 - F.col("l_discount").cast("decimal(15,2)"))
    product = (F.floor(a * b * 10000) / 10000).cast("decimal(18,4)")
    return table(spark, sf_dir, "lineitem").agg(F.sum(product).cast("double").alias("total"))


def expr_min_sin_cos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.round(F.min(F.sin(x()) * F.cos(y()) + F.sqrt(x() * y())), 9).alias("value"))


def replace_mul(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator * replaced by twice its left side."""
    ops = Replacements().replace("*", lambda a, b: a * 2)
    return table(spark, sf_dir, "lineitem").agg(F.round(F.sum(ops.mul(F.col("l_quantity"), F.col("l_tax"))), 4).alias("total"))


def replace_sqrt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sqrt replaced by adding 100."""
    ops = Replacements().replace("sqrt", lambda a: a + 100)
    return table(spark, sf_dir, "lineitem").agg(F.round(F.sum(ops.call("sqrt", F.col("l_quantity"))), 4).alias("total"))


def agg_empty_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.lit(False)).agg(agg.from_sum("double")(F.col("l_quantity")).alias("value"))


def agg_empty_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reducer whose result without rows is its initial value."""
    return table(spark, sf_dir, "lineitem").where(F.lit(False)).agg(agg.from_sum("double", empty="init")(F.col("l_quantity")).alias("value"))


QUERIES = {
    **{f"math_{k}": _summed(c, 4) for k, (c, _) in MATH.items()},
    **{f"micro_{k}": _summed(c, 2) for k, (c, _) in MICRO.items()},
    **{f"agg_{k}": _reduced(f, None) for k, (f, _) in REDUCERS.items() if k != "reduce_max"},
    **{f"agg_{k}_by_supplier": _reduced(f, "l_suppkey") for k, (f, _) in REDUCERS.items()},
    "agg_reduce_max_by_supplier": agg_reduce_max_by_supplier,
    "agg_product": _reduced(agg.from_product("double"), None, FEW),
    "agg_product_all": agg_product_all,
    "agg_product_by_order": agg_product_by_order,
    "dec_mul_floor": dec_mul_floor,
    "expr_min_sin_cos": expr_min_sin_cos,
    "replace_mul": replace_mul,
    "replace_sqrt": replace_sqrt,
    "agg_empty_null": agg_empty_null,
    "agg_empty_init": agg_empty_init,
}

ORACLE = {
    **{f"math_{k}": f"SELECT round(sum({s}), 4) AS total FROM lineitem" for k, (_, s) in MATH.items()},
    **{f"micro_{k}": f"SELECT round(sum({s}), 2) AS total FROM lineitem" for k, (_, s) in MICRO.items()},
    **{f"agg_{k}": f"SELECT round({s}, 6) AS value FROM lineitem" for k, (_, s) in REDUCERS.items() if k != "reduce_max"},
    **{f"agg_{k}_by_supplier": f"SELECT l_suppkey, round({s}, 6) AS value FROM lineitem GROUP BY 1" for k, (_, s) in REDUCERS.items()},
    "agg_product": f"SELECT round(product(l_quantity), 6) AS value FROM lineitem {_FEW}",
    "agg_product_all": "SELECT round(product(1 + l_discount / 1e6), 9) AS value FROM lineitem",
    "agg_product_by_order": "SELECT l_orderkey, product(l_quantity) AS value FROM lineitem GROUP BY 1",
    "dec_mul_floor": "SELECT CAST(sum(CAST(floor(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2))) * 10000) / 10000 AS DECIMAL(18,4))) AS DOUBLE) AS total FROM lineitem",
    "expr_min_sin_cos": f"SELECT round(min(sin({_SX}) * cos({_SY}) + sqrt({_SX} * {_SY})), 9) AS value FROM lineitem",
    "replace_mul": "SELECT round(sum(l_quantity * 2), 4) AS total FROM lineitem",
    "replace_sqrt": "SELECT round(sum(l_quantity + 100), 4) AS total FROM lineitem",
    "agg_empty_null": "SELECT CAST(NULL AS DOUBLE) AS value",
    "agg_empty_init": "SELECT CAST(0 AS DOUBLE) AS value",
}
