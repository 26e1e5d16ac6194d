"""Joins, set operations, windows, grouping sets, nested values and table functions over the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arithmetic
from ..functions import table as table_functions
from ..operators import joins
from ..sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Registers a query with the SQL that gives the same rows."""

    def put(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return put


@query("SELECT c_mktsegment, count(*) AS n, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS total FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) o ON c_custkey = o_custkey GROUP BY 1")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_custkey", "o_orderkey", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT s.s_suppkey, c.c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 0) s FULL JOIN (SELECT * FROM customer WHERE c_acctbal < 0) c ON s.s_suppkey = c.c_custkey")
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    c = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return s.join(c, s.s_suppkey == c.c_custkey, "full")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_acctbal > 9000")
    return o.join(c, o.o_custkey == c.c_custkey, "left_semi").select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_totalprice > 200000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query(
    "SELECT e.event_id, p.value AS last_purchase FROM (SELECT * FROM events WHERE event_type = 'click') e ASOF LEFT JOIN "
    "(SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON e.user_id = p.user_id AND e.ts >= p.ts"
)
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    left = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("last_purchase"))
    return joins.asof(left, right, ["user_id"], "ts", "last_purchase").select("event_id", "last_purchase")


@query("SELECT p_partkey, lo FROM part, (SELECT DISTINCT CAST(p_size AS BIGINT) * 20 + 900 AS lo FROM part) r WHERE p_retailprice >= lo AND p_retailprice < lo + 3")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    lo = p.select((F.col("p_size").cast("bigint") * 20 + 900).alias("lo")).distinct().withColumn("hi", F.col("lo") + 3)
    return joins.in_range(p.select("p_partkey", "p_retailprice"), lo, "p_retailprice", "lo", "hi", 3.0).select("p_partkey", "lo")


@query("SELECT n_name, r_name FROM nation CROSS JOIN region WHERE n_regionkey < r_regionkey")
def join_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of fixed size: 25 nations and 5 regions."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey < r.r_regionkey).select("n_name", "r_name")


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 UNION SELECT s_nationkey FROM supplier")
def set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").where("c_acctbal > 5000"), table(spark, sf_dir, "supplier")
    return c.select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT s_nationkey FROM supplier")
def set_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = table(spark, sf_dir, "customer").where("c_acctbal > 5000"), table(spark, sf_dir, "supplier")
    return c.select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def set_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_totalprice > 300000")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(o.select("o_custkey"))


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def set_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where("o_totalprice > 200000")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(o.select("o_custkey"))


@query("SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders QUALIFY r <= 3")
def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.rank().over(w).cast("bigint").alias("r")).where("r <= 3")


@query("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM orders")
def win_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(-2, 0)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(w), 2).alias("s"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def group_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def group_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("q"))


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders GROUP BY 1 HAVING count(*) > 10")
def group_distinct_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_orderpriority")
    return o.agg(F.count_distinct("o_custkey").alias("customers"), F.count_if(F.col("o_totalprice") > 100000).alias("large"), F.count(F.lit(1)).alias("n")).where("n > 10").drop("n")


@query("SELECT p_brand, median(p_retailprice) AS m FROM part GROUP BY 1")
def group_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.median("p_retailprice").alias("m"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL ORDER BY n DESC, o_custkey LIMIT 3")
def busiest_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey").limit(3)


@query("SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F, count(*) FILTER (WHERE l_linestatus = 'O') AS O FROM lineitem GROUP BY 1")
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.count(F.lit(1)))
    return counts.select("l_returnflag", F.coalesce("F", F.lit(0)).alias("F"), F.coalesce("O", F.lit(0)).alias("O"))


@query("WITH RECURSIVE t(i, s) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT i + 1, s + i + 1 FROM t WHERE i < 20) SELECT i, s FROM t")
def cte_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("WITH RECURSIVE t(i, s) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT i + 1, s + i + 1 FROM t WHERE i < 20) SELECT i, s FROM t")


@query("SELECT label, count(*) AS n, round(sum(CAST(x AS DOUBLE)), 4) AS total FROM (SELECT label, unnest(embedding) AS x FROM embeddings) GROUP BY 1")
def list_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("x"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("x").cast("double")), 4).alias("total"))


@query("SELECT vec_id, len(embedding) AS n, CAST(embedding[1] AS DOUBLE) AS first, CAST(list_max(embedding) AS DOUBLE) AS largest FROM embeddings")
def list_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").cast("bigint").alias("n"), F.element_at("embedding", 1).cast("double").alias("first"), F.array_max("embedding").cast("double").alias("largest"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY 1, 2")
def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return table(spark, sf_dir, "events").groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query("SELECT c_custkey, nullif(c_acctbal, 0) IS NULL AS none, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE upper(c_mktsegment) END AS kind FROM customer ORDER BY kind NULLS LAST, c_custkey LIMIT 50")
def case_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_order_all(spark, sf_dir).limit(50)


@query("SELECT c_custkey, nullif(c_acctbal, 0) IS NULL AS none, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE upper(c_mktsegment) END AS kind FROM customer ORDER BY kind NULLS LAST, c_custkey")
def case_order_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, so that every branch and the nulls at the end are in the result."""
    kind = F.when(F.col("c_acctbal") < 0, "debt").otherwise(F.upper("c_mktsegment"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_acctbal", F.lit(0.0)).isNull().alias("none"), kind.alias("kind"))
    return rows.orderBy(F.asc_nulls_last("kind"), "c_custkey")


@query("SELECT CAST(4950 AS BIGINT) AS total, CAST(100 AS BIGINT) AS n")
def udtf_counter_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.newSession()
    table_functions.register(s)
    return s.sql("SELECT sum(i) AS total, count(*) AS n FROM counter(100)")


@query("SELECT i AS i FROM range(3, 10) t(i) WHERE i > 5")
def udtf_counter_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_functions.counter(spark, 7, 3).where("i > 5")


@query("SELECT n_name AS name, i FROM nation, range(5) t(i) WHERE n_nationkey = i")
def udtf_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return table_functions.counter(spark, 5).join(n, F.col("i") == n.n_nationkey).select(F.col("n_name").alias("name"), "i")


@query("SELECT * FROM (VALUES (1, 'alice', CAST(0.0 AS DOUBLE)), (2, 'bob', 10.5), (3, 'carol', 21.0)) t(id, name, score)")
def udtf_multi_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.newSession()
    table_functions.register(s)
    return s.sql("SELECT * FROM multi_col()")


@query("SELECT CAST(sum(i + 2 * i) AS BIGINT) AS total, CAST(sum(-i) AS BIGINT) AS negated, CAST(sum(3 * i) AS BIGINT) AS tripled FROM range(1, 101) t(i)")
def ext_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.newSession()
    arithmetic.register(s)
    return s.sql("SELECT sum(add_numbers(id, 2 * id)) AS total, sum(negate_number(id)) AS negated, sum(triple(id)) AS tripled FROM range(1, 101)")
