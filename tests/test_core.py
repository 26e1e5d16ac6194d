import dataclasses

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from sparkloom.functions import aggregate, extension, scalar, table
from sparkloom.functions.replace import Replacements
from sparkloom.operators import joins
from sparkloom.result import ResultError
from sparkloom.session import Config, Database, connect, quote_name, quote_text, statement_type
from sparkloom.sources.appender import Appender
from sparkloom.streaming import windows

SF = "/root/testdata/sf0.001"


@pytest.fixture
def con(spark):
    return connect(database=Database(spark))


def test_parameters(con):
    assert con.execute("SELECT ? + ?", [40, 2]).fetchone()[0] == 42
    assert con.execute("SELECT :x * 2 AS y", {"x": 4}).fetchall().get(0, "y", int) == 8
    p = con.prepare("SELECT :a + :b AS s")
    assert p.names == ["a", "b"]
    assert p.bind("a", 1).bind("b", 2).execute().fetchone()[0] == 3
    with pytest.raises(KeyError):
        p.bind("c", 1)
    p.clear()
    with pytest.raises(ValueError):
        p.execute()


def test_errors(con):
    with pytest.raises(ResultError) as e:
        con.execute("SELEC 1")
    assert e.value.kind == "parser"
    with pytest.raises(ResultError) as e:
        con.execute("SELECT * FROM nowhere_at_all")
    assert e.value.kind == "catalog"


def test_cursor_and_decoding(con):
    r = con.execute("SELECT id, if(id = 1, NULL, 'n' || id) AS name FROM range(5) ORDER BY id")
    assert r.fetchone() == (0, "n0")
    assert len(r.fetchmany(2)) == 2
    assert [x[0] for x in r] == [3, 4]
    assert r.fetchone() is None
    m = con.execute("SELECT id, if(id = 1, NULL, 'n' || id) AS name FROM range(5) ORDER BY id").fetchall()

    @dataclasses.dataclass
    class P:
        id: int
        name: str | None

    assert m.rows(P)[1] == P(1, None)
    with pytest.raises(TypeError, match="null"):
        m.rows(tuple[int, str])
    with pytest.raises(TypeError):
        m.get(0, "id", str)
    assert m.is_null("name", 1) and not m.is_null("name")
    assert r.description[0] == (0, "id", "bigint")


def test_show(con):
    text = con.execute("SELECT id FROM range(10)").show(4)
    assert text.count("·") == 3 and text.endswith("10 rows (4 shown)")
    assert "·" not in con.execute("SELECT id FROM range(7)").show(4)


def test_read_only_and_config(spark):
    con = connect(read_only=True, database=Database(spark))
    with pytest.raises(PermissionError):
        con.execute("CREATE TABLE nope (a INT)")
    with pytest.raises(ValueError):
        Config({"nothing": 1})
    assert connect(config={"threads": 3}, database=Database(spark)).setting("threads") == "3"
    assert statement_type("-- x\n WITH a AS (SELECT 1) SELECT * FROM a") == "select"
    assert statement_type("nonsense") == "invalid"


def test_shared_functions(spark):
    db = Database(spark)
    a, b = db.connect(), db.connect()
    a.register("plus_one", scalar.row(lambda x: x + 1, "bigint"))
    assert b.execute("SELECT plus_one(41)").fetchone()[0] == 42
    assert b.execute("SELECT plus_one(CAST(NULL AS BIGINT))").fetchone()[0] is None


def test_appender_and_dml(con):
    con.execute("DROP TABLE IF EXISTS people")
    con.execute("CREATE TABLE people (id INT, name STRING, tags ARRAY<INT>) USING parquet")
    with Appender(con.spark, "people") as a:
        a.append_row((1, "ann", [1, 2]))
        a.append_rows([(2, None, []), (3, "cy", None)])
        a.append(4).append_null().append([9]).end_row()
        with pytest.raises(ValueError):
            a.append_row((1, 2))
        a.row = None
    assert con.execute("SELECT count(*), count(name), sum(id) FROM people").fetchone() == (4, 2, 10)
    assert con.update("people", {"name": "'bob'"}, "name IS NULL") == 2
    assert con.delete("people", "id > 3") == 1
    assert con.delete("people", "NULL") == 0
    assert [r[0] for r in con.execute("SELECT name FROM people ORDER BY id")] == ["ann", "bob", "cy"]
    with pytest.raises(ValueError):
        Appender(con.spark, "no_such_table")


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 5), ("b", -2)], "g string, x int")
    out = {r["g"]: r for r in df.groupBy("g").agg(aggregate.from_sum("int")(F.col("x")).alias("s"), aggregate.from_reduce(lambda a, b: a * b, 1, "int")(F.col("x")).alias("p")).collect()}
    assert (out["a"]["s"], out["b"]["s"], out["b"]["p"]) == (1, 3, -10)
    empty = df.where("false").agg(aggregate.from_reduce(lambda a, b: a + b, 0, "int")(F.col("x")).alias("n"), aggregate.from_sum("int", "init")(F.col("x")).alias("z")).first()
    assert empty["n"] is None and empty["z"] == 0
    two = aggregate.two_stage(spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("x")), ["g"], "x", lambda s, a: s + (pc.sum(a).as_py() or 0), lambda a, b: a + b, lambda s: s, 0, "bigint", "bigint")
    want = {r["g"]: r["s"] for r in spark.range(100).groupBy((F.col("id") % 3).alias("g")).agg(F.sum("id").alias("s")).collect()}
    assert {r["g"]: r["value"] for r in two.collect()} == want
    f = aggregate.AggregateSet("total").add("int", aggregate.from_sum("int"))
    assert df.agg(f.on(df, "x")).first()[0] == 4
    with pytest.raises(TypeError):
        f.on(df, "g")


def test_replacement(spark):
    r = Replacements().replace("*", lambda a, b: a * 2).replace("sqrt", lambda a: a + 100)
    row = spark.sql("SELECT 2 AS x, 5 AS y, 25.0D AS z").select(r.mul(F.col("x"), F.col("y")), r.call("sqrt", F.col("z")), r.mul(3, 4), r.add(r.mul(F.col("x"), F.col("y")), F.col("y"))).first()
    assert tuple(row) == (4, 125.0, 12, 9)
    assert r.names() == ["*", "sqrt"]
    bad = Replacements().replace("+", lambda a: a)
    assert spark.range(1).select(bad.add(F.col("id"), 1)).first()[0] == 1


def test_table_functions_and_extension(spark):
    s = spark.newSession()
    table.register(s)
    assert [r[0] for r in s.sql("SELECT i FROM counter(3, start => 5)").collect()] == [5, 6, 7]
    assert s.sql("SELECT * FROM multi_col()").count() == 3
    extension.load(s, "sparkloom.functions.arithmetic")
    assert s.sql("SELECT triple(14), negate_number(1)").first() == (42, -1)
    overloads = scalar.FunctionSet("twice").add(("bigint",), lambda c: c * 2)
    df = spark.range(3)
    assert [r[0] for r in df.select(overloads.on(df, "id")).collect()] == [0, 2, 4]


def test_parameter_forms(con):
    assert con.execute("SELECT $1 - $2 AS x, '$3' AS y", [5, 2]).fetchone() == (3, "$3")
    assert con.execute("SELECT $a * 2 AS x -- $b", {"a": 4}).fetchone()[0] == 8
    p = con.prepare("SELECT $1 + $2 AS s /* $9 ? */")
    assert p.count == 2 and p.bind(1, 1).bind(2, 2).execute().fetchone()[0] == 3
    named = con.prepare("SELECT :b AS b, :a AS a")
    assert named.index("a") == 2


def test_read_only_is_told_by_what_a_statement_does(con, spark):
    con.execute("DROP TABLE IF EXISTS ro")
    con.execute("CREATE TABLE ro (a INT) USING parquet")
    con.config.set("access_mode", "READ_ONLY")
    con.read_only = True
    for text in ("/* c */ INSERT INTO ro VALUES (1)", "WITH x AS (SELECT 1) INSERT INTO ro SELECT * FROM x", "FROM (SELECT 1) INSERT INTO ro SELECT *", "-- a\nDROP TABLE ro", "TRUNCATE TABLE ro"):
        with pytest.raises(PermissionError):
            con.execute(text)
    with pytest.raises(PermissionError):
        con.executemany("INSERT INTO ro VALUES (?)", [(1,)])
    assert con.execute("WITH x AS (SELECT 'insert into' AS t) SELECT * FROM x").fetchone()[0] == "insert into"
    assert con.execute("(SELECT count(*) FROM ro)").fetchone()[0] == 0


def test_rows_changed_and_many_rows(con):
    con.execute("DROP TABLE IF EXISTS many")
    con.execute("CREATE TABLE many (id INT, name STRING, tags ARRAY<INT>) USING parquet")
    assert con.execute("INSERT INTO many VALUES (1, 'a', array(1)), (2, NULL, NULL)").rows_changed == 2
    assert con.execute("WITH x AS (SELECT 1) SELECT * FROM x").rows_changed == 0
    assert con.executemany("INSERT INTO many (name, id) VALUES (?, ?)", [(f"n{i}", i) for i in range(3, 500)]) == 497
    assert con.execute("SELECT count(*), count(tags), max(id) FROM many").fetchone() == (499, 1, 499)
    assert con.executemany("INSERT INTO many SELECT :i, 'x', NULL", [{"i": 1000}, {"i": 1001}]) == 2
    assert con.execute("SELECT count(*) FROM many").fetchone()[0] == 501
    with pytest.raises(ValueError, match="no columns"):
        con.update("many", {"nothing": "1"})
    batches = list(con.execute("SELECT id, named_struct('n', name, 'm', map('k', id)) AS s FROM many ORDER BY id").chunks(200))
    assert [b.num_rows for b in batches] == [200, 200, 101] and batches[0].column(1)[0].as_py() == {"n": "a", "m": [("k", 1)]}
    assert con.execute(f"SELECT {quote_text(chr(39) + chr(92))} AS {quote_name('a `b`')}").fetchall().table.to_pydict() == {"a `b`": ["'" + chr(92)]}


def test_rewritten_tables_keep_their_partitions(con):
    con.execute("DROP TABLE IF EXISTS parted")
    con.execute("CREATE TABLE parted (id INT, p INT) USING parquet PARTITIONED BY (p)")
    con.execute("INSERT INTO parted VALUES (1, 1), (2, 1), (3, 2)")
    assert con.update("parted", {"id": "id * 10"}, "p = 1") == 2 and con.delete("parted", "p = 2") == 1
    assert sorted(con.execute("SELECT id FROM parted").fetchall().column("id")) == [10, 20]
    assert con.execute("SHOW PARTITIONS parted").fetchall().rows() == [("p=1",)]


def test_unstable_extensions(spark, monkeypatch):
    from sparkloom.functions import arithmetic

    monkeypatch.setattr(arithmetic, "UNSTABLE", True, raising=False)
    with pytest.raises(ImportError, match="may change"):
        extension.load(spark.newSession(), "sparkloom.functions.arithmetic")
    extension.load(spark.newSession(), "sparkloom.functions.arithmetic", allow_unstable=True)


def test_asof_takes_the_last_row_even_if_null(spark):
    left = spark.createDataFrame([(1, "2024-01-02 10:00:00"), (1, "2024-01-03 10:00:00"), (2, "2024-01-01 00:00:00")], "k int, t string").withColumn("t", F.to_timestamp("t"))
    right = spark.createDataFrame([(1, "2024-01-02 08:00:00", 5.0), (1, "2024-01-02 09:00:00", None)], "k int, t string, v double").withColumn("t", F.to_timestamp("t"))
    for bucket in (None, "day"):
        assert [r["v"] for r in joins.asof(left, right, ["k"], "t", "v", bucket).collect()] == [None] * 3
    right = right.where("v IS NOT NULL")
    for bucket in (None, "day"):
        assert sorted(str(r["v"]) for r in joins.asof(left, right, ["k"], "t", "v", bucket).collect()) == ["5.0", "5.0", "None"]


def test_asof_with_and_without_buckets(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    left = e.where("event_id % 2 = 0").select("event_id", "user_id", "ts")
    right = e.where("event_id % 2 = 1").groupBy("user_id", "ts").agg(F.max("value").alias("v"))
    a = joins.asof(left, right, ["user_id"], "ts", "v").select("event_id", "v").collect()
    b = joins.asof(left, right, ["user_id"], "ts", "v", "day").select("event_id", "v").collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == left.count()


def test_windows(spark):
    e = spark.read.parquet(f"{SF}/events.parquet")
    assert windows.tumbling(e, "1 day", "1 hour").agg(F.sum("n")).first()[0] == e.count()


def test_batch_function(spark):
    import pandas as pd

    def double(x: pd.Series) -> pd.Series:
        return x * 2

    f = scalar.batch(double, "bigint")
    assert [r[0] for r in spark.range(3).select(f("id")).collect()] == [0, 2, 4]
    assert isinstance(spark.range(2).toArrow(), pa.Table)


def test_two_stage_makes_one_state_of_a_group_in_a_task(spark):
    """Groups that reach over batches, keys that are null or NaN, and states of nothing but null."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "50")
    try:
        made = spark.sparkContext.accumulator(0)
        nan = float("nan")
        rows = [(g, h, i if g != "d" else None) for i in range(300) for g, h in (("a", 1.0), ("a", nan), ("b", None), (None, 0.0), ("c", -0.0 if i % 2 else 0.0), ("d", 2.0))]
        df = spark.createDataFrame(rows, "g string, h double, x bigint").repartition(3)

        def combine(a, b):
            made.add(1)
            return b if a is None else a if b is None else a + b

        def update(s, a):
            return s if (n := pc.sum(a).as_py()) is None else n + (s or 0)

        got = aggregate.two_stage(df, ["g", "h"], "x", update, combine, lambda s: s, None, "bigint", "bigint").collect()
        total = sum(range(300))
        want = [("a", "1.0", total), ("a", "nan", total), ("b", "None", total), ("None", "0.0", total), ("c", "0.0", total), ("d", "2.0", None)]
        assert sorted((str(r["g"]), str(abs(r["h"]) if r["h"] is not None else None), r["value"]) for r in got) == sorted((str(g), h, v) for g, h, v in want)
        assert made.value == 3 * len(want)
        whole = aggregate.two_stage(df, [], "x", update, combine, lambda s: s, None, "bigint", "bigint").collect()
        assert [tuple(r) for r in whole] == [(5 * total,)]
        assert aggregate.two_stage(df.where("false"), ["g"], "x", update, combine, lambda s: s, None, "bigint", "bigint").count() == 0
    finally:
        spark.conf.set(name, before)
