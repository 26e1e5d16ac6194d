"""Helpers that several operators use: the shared folder, saved tables, connected components, word hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting that removes a query's shuffle files when it has ended.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session (one process, as in tests) gets a folder of its own, and a cluster an error."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="sparkloom-"))
    return _own[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def tidy(spark: SparkSession):
    """Shuffle files of the queries that run within it go as each ends, not when the driver collects its garbage, and Arrow batches are small, so that tasks hold little."""
    own = {TIDY: "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: it cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes tables that saved() wrote and that nothing reads any more. On a store that pyarrow can't reach they stay."""
    for path in {f.rpartition("/")[0] for t in tables for f in t.inputFiles()}:
        try:
            store, at = fs.FileSystem.from_uri(path)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            continue
        store.delete_dir(at)


#: Edges that one task contracts at a time.
SHARE = 50_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each share of edges (u, v) its components as stars: every other node with the smallest."""

    def stars(parent: dict[int, int]) -> pa.RecordBatch:
        rows = [(u, v) for u in parent if (v := _root(parent, u)) != u]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["u", "v"])

    parent: dict[int, int] = {}
    have = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARE):
            part = batch.slice(at, SHARE)
            if have and have + part.num_rows > SHARE:
                yield stars(parent)
                parent, have = {}, 0
            have += part.num_rows
            for u, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                a, b = _root(parent, u), _root(parent, v)
                parent[max(a, b)] = min(a, b)
    yield stars(parent)


def _root(parent: dict[int, int], u: int) -> int:
    while (v := parent.setdefault(u, u)) != u:
        parent[u] = u = parent.setdefault(v, v)
    return u


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component being the smallest node of each.

    Every task contracts shares of at most SHARE edges to stars. Of several shares, large-star and
    small-star steps alternate after that until nothing changes; every step is a join on a node and
    its smallest neighbour, so no component is ever in one task. Nodes without an edge to another
    node give no row; an edge with a null end is ignored.
    """

    def contracted(x: DataFrame, n: int) -> DataFrame:
        return saved(x.coalesce(max(1, -(-n // SHARE))).mapInArrow(_forest, "u bigint, v bigint"), "edges")

    def mark(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = saved(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").cast("bigint").alias("u"), F.least("a", "b").cast("bigint").alias("v")), "edges")
    n = e.count()
    e = contracted(e, n)
    before = mark(e) if n > SHARE else [0]
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(small.union(small_least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if (now := mark(e)) == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


#: Random 64-bit values of bytes, from which word hashes are summed; seeded, so the same in every task.
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The base of the polynomial, and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n or more powers of BASE and of its inverse."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        with np.errstate(over="ignore"):
            _powers.clear()
            _powers[size] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (BASE, BASE_INVERSE))
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that is_word (256 flags) marks."""
    flags = is_word[data]
    edge = np.flatnonzero(np.diff(flags.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; the same word has the same one wherever it stands."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
