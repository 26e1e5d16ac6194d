"""Every query of the core library against its SQL."""

import math

import pytest
from sparkloom.plans import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, oracle, name):
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    cursor = oracle.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    key = lambda r: tuple(str(plain(r[c])) for c in columns)
    got = [r.asDict() for r in df.collect()]
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_products_read_all_rows(spark):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    by_order = registry.queries()["agg_product_by_order"](spark, SF).collect()
    assert len(by_order) == lineitem.select("l_orderkey").distinct().count()
    want = math.fsum(math.log1p(r[0] / 1e6) for r in lineitem.select("l_discount").collect())
    assert math.isclose(registry.queries()["agg_product_all"](spark, SF).first()["value"], math.exp(want), abs_tol=2e-9)


def test_case_order_returns_all_rows_in_order(spark, tmp_path):
    rows = [(1, 5.0, "b"), (2, -1.0, "a"), (3, 0.0, None), (4, None, None), (5, 2.0, "a"), (6, -3.0, None)] + [(i, 1.0, "a") for i in range(10, 80)]
    spark.createDataFrame(rows, "c_custkey bigint, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = [tuple(r) for r in registry.queries()["case_order_all"](spark, str(tmp_path)).collect()]
    a = [(5, False, "A"), *((i, False, "A") for i in range(10, 80))]
    assert got == [*a, (1, False, "B"), (2, False, "debt"), (6, False, "debt"), (3, True, None), (4, True, None)]


def test_reduce_by_supplier_collects_no_group(spark, tmp_path):
    rows = [(1, float(i)) for i in range(5000)] + [(2, None), (3, 7.5), (3, None), (3, -1.0)]
    spark.createDataFrame(rows, "l_suppkey bigint, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = registry.queries()["agg_reduce_max_by_supplier"](spark, str(tmp_path))
    assert "collect_list" not in df._jdf.queryExecution().toString()
    assert sorted(map(tuple, df.collect())) == [(1, 4999.0), (2, None), (3, 7.5)]


def test_reduce_by_supplier_takes_nan_as_largest(spark, tmp_path):
    rows = [(1, 2.0), (1, math.nan), (1, 3.0), (2, -math.inf), (3, None), (None, 4.0), (None, 5.0)]
    spark.createDataFrame(rows, "l_suppkey bigint, l_quantity double").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = registry.queries()["agg_reduce_max_by_supplier"](spark, str(tmp_path)).collect()
    assert {r[0]: str(r[1]) for r in got} == {1: "nan", 2: "-inf", 3: "None", None: "5.0"}
