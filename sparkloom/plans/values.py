"""Nested values, decimals, bits, intervals, strings and further aggregates, joins and windows over the standard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

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


@query("SELECT c_custkey, s.seg AS seg, s.at.nation AS nation FROM (SELECT c_custkey, {'seg': c_mktsegment, 'at': {'nation': c_nationkey}} AS s FROM customer)")
def struct_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.struct(F.col("c_mktsegment").alias("seg"), F.struct(F.col("c_nationkey").alias("nation")).alias("at")).alias("s")
    return table(spark, sf_dir, "customer").select("c_custkey", s).select("c_custkey", "s.seg", F.col("s.at.nation").alias("nation"))


@query("SELECT o_orderkey, MAP {'status': o_orderstatus, 'priority': o_orderpriority}['priority'] AS priority, cardinality(MAP {'status': o_orderstatus, 'priority': o_orderpriority})::BIGINT AS n, MAP {'status': o_orderstatus}['none'] AS none FROM orders")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority").alias("m")
    return table(spark, sf_dir, "orders").select("o_orderkey", m).select("o_orderkey", F.try_element_at("m", F.lit("priority")).alias("priority"), F.size("m").cast("bigint").alias("n"), F.try_element_at("m", F.lit("none")).alias("none"))


@query("SELECT p_partkey, len(range(p_size))::BIGINT AS n, list_sum(range(p_size))::BIGINT AS total, range(p_size)[1] AS first FROM part WHERE p_size > 0")
def list_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = F.sequence(F.lit(0).cast("bigint"), F.col("p_size").cast("bigint") - 1)
    total = F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return table(spark, sf_dir, "part").where("p_size > 0").select("p_partkey", steps.alias("r")).select("p_partkey", F.size("r").cast("bigint").alias("n"), total.alias("total"), F.element_at("r", 1).alias("first"))


@query("SELECT n_nationkey, list_contains([1, 3, 5, 7], n_nationkey) AS odd, list_position([1, 3, 5, 7], n_nationkey)::BIGINT AS place, [n_nationkey, n_regionkey][2] AS second FROM nation")
def list_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.array(*map(F.lit, (1, 3, 5, 7)))
    place = F.array_position(odd, F.col("n_nationkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_contains(odd, F.col("n_nationkey")).alias("odd"), F.when(place > 0, place).alias("place"), F.element_at(F.array("n_nationkey", "n_regionkey"), 2).alias("second"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::BIGINT AS positive, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)), 6) AS square FROM embeddings")
def list_lambdas(spark: SparkSession, sf_dir: str) -> DataFrame:
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).cast("bigint").alias("positive"), F.round(square, 6).alias("square"))


@query("SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY 1")
def list_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of five segments: the set of a group is small however many rows it has."""
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"), F.count_distinct("c_mktsegment").alias("n"))


@query("SELECT r_name, count(n_nationkey) AS n FROM nation RIGHT JOIN (SELECT * FROM region) r ON n_regionkey = r_regionkey AND n_nationkey > 12 GROUP BY 1")
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation").where("n_nationkey > 12"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "right").groupBy("r_name").agg(F.count("n_nationkey").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, grouping(o_orderstatus)::BIGINT AS g FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def group_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupingSets([[o.o_orderstatus], [o.o_orderpriority], []], o.o_orderstatus, o.o_orderpriority).agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").cast("bigint").alias("g"))


@query("SELECT p_brand, quantile_cont(p_retailprice, 0.25) AS q1, quantile_cont(p_retailprice, 0.75) AS q3 FROM part GROUP BY 1")
def group_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.percentile("p_retailprice", 0.25).alias("q1"), F.percentile("p_retailprice", 0.75).alias("q3"))


@query("SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS v, round(corr(l_quantity, l_extendedprice), 6) AS c FROM lineitem GROUP BY 1")
def group_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.stddev_samp("l_quantity"), 6).alias("sd"), F.round(F.var_pop("l_quantity"), 6).alias("v"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("c"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest, bool_and(o_totalprice > 1000) AS every, bool_or(o_totalprice > 300000) AS some FROM orders GROUP BY 1")
def group_arg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(best.alias("dearest"), F.bool_and(F.col("o_totalprice") > 1000).alias("every"), F.bool_or(F.col("o_totalprice") > 300000).alias("some"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(12,2)) + CAST(l_tax AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS plus, CAST(CAST(l_quantity AS DECIMAL(12,2)) - CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS minus FROM lineitem")
def decimal_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, t, d = (F.col(c).cast("decimal(12,2)") for c in ("l_quantity", "l_tax", "l_discount"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (q + t).cast("decimal(14,2)").alias("plus"), (q - d).cast("decimal(14,2)").alias("minus"))


@query("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS total, CAST(max(CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(4,2)) AS most FROM lineitem GROUP BY 1")
def decimal_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sums, whatever the order in which tasks add them."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(38,2)").alias("total"), F.max(F.col("l_tax").cast("decimal(4,2)")).alias("most"))


@query("SELECT p_partkey, TRY_CAST(p_size * 10 AS TINYINT) AS tiny, TRY_CAST(p_partkey * 100 AS SMALLINT) AS small, TRY_CAST(p_brand AS INTEGER) AS number FROM part")
def try_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "try_cast(p_size * 10 AS TINYINT) AS tiny", "try_cast(p_partkey * 100 AS SMALLINT) AS small", "try_cast(p_brand AS INT) AS number")


@query("SELECT event_id, (event_id & 255)::BIGINT AS low, (event_id | 1)::BIGINT AS odd, xor(event_id, user_id)::BIGINT AS mixed, (event_id << 3)::BIGINT AS up, (event_id >> 2)::BIGINT AS down, bit_count(event_id)::BIGINT AS ones FROM events")
def bit_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", e.bitwiseAND(255).alias("low"), e.bitwiseOR(1).alias("odd"), e.bitwiseXOR(F.col("user_id")).alias("mixed"), F.shiftleft(e, 3).alias("up"), F.shiftright(e, 2).alias("down"), F.bit_count(e).cast("bigint").alias("ones"))


@query("SELECT event_id, ts + INTERVAL 90 MINUTE AS later, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::BIGINT AS days, extract(hour FROM ts)::BIGINT AS hour, extract(isodow FROM ts)::BIGINT AS weekday, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    later = F.expr("ts + INTERVAL '90' MINUTE").alias("later")
    days = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("bigint").alias("days")
    whole = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    return e.select("event_id", later, days, F.hour("ts").cast("bigint").alias("hour"), (F.weekday("ts") + 1).cast("bigint").alias("weekday"), whole.alias("seconds"))


@query(
    "SELECT c_custkey, lower(c_mktsegment) AS low, substr(c_name, 1, 8) AS head, replace(c_name, '#', '-') AS dashed, regexp_extract(c_name, '([0-9]+)', 1) AS digits, "
    "lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded, concat_ws('/', c_mktsegment, c_name) AS joined, strlen(c_name)::BIGINT AS size, c_name LIKE '%7' AS seven FROM customer"
)
def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("low"), F.substring("c_name", 1, 8).alias("head"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("dashed"), F.regexp_extract("c_name", "([0-9]+)", 1).alias("digits"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("padded"), F.concat_ws("/", "c_mktsegment", "c_name").alias("joined"), F.octet_length("c_name").cast("bigint").alias("size"), F.col("c_name").like("%7").alias("seven"),
    )


@query("SELECT s_suppkey, coalesce(nullif(s_nationkey, 3), -1) AS c, greatest(s_acctbal, 0) AS g, least(s_acctbal, 0) AS l, s_nationkey % 7 AS m, s_acctbal BETWEEN 0 AND 5000 AS b, s_nationkey IN (1, 2, 3) AS i FROM supplier")
def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, a = F.col("s_nationkey"), F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.coalesce(F.nullif(n, F.lit(3)), F.lit(-1)).alias("c"), F.greatest(a, F.lit(0.0)).alias("g"), F.least(a, F.lit(0.0)).alias("l"), (n % 7).alias("m"), a.between(0, 5000).alias("b"), n.isin(1, 2, 3).alias("i"))


@query("SELECT o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, first_value(o_orderkey) OVER w AS first, row_number() OVER w AS n, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS d FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def win_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    d = F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderpriority")).cast("bigint")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"), F.first("o_orderkey").over(w).alias("first"), F.row_number().over(w).cast("bigint").alias("n"), d.alias("d"))


@query("SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer")
def subquery_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders")
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return c.join(counts, c.c_custkey == counts.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 ELSE 3 END AS kind, CASE WHEN p_size < 10 THEN 's' WHEN p_size < 30 THEN 'm' ELSE 'l' END AS size FROM part")
def case_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, s = F.col("p_type"), F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(t == "PROMO", 1).when(t == "ECONOMY", 2).otherwise(3).alias("kind"), F.when(s < 10, "s").when(s < 30, "m").otherwise("l").alias("size"))


@query("SELECT l_returnflag, CAST(approx_count_distinct(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def group_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches are exact for so few distinct values; their states merge, however many rows a group has."""
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_linenumber").alias("n"))


@query("SELECT k AS k, count(*) AS n FROM (SELECT unnest(map_keys(MAP {'kind': event_type, 'user': CAST(user_id AS VARCHAR)})) AS k FROM events) GROUP BY 1")
def map_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("kind"), "event_type", F.lit("user"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(F.explode(F.map_keys(m)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
