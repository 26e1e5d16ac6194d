"""N-gram Jaccard join by signature trees.

Equal shingle sets become one node. Nodes that may be similar are brought together exactly: the
shingles of each set are put in order of how often their counter has been met in all sets, rarest
first, and two sets of enough likeness share one of their first few. The counters are a fixed
number of sums over all documents; they only order shingles, so shared ones lose no link. Nodes
that share a rare shingle and whose bitmaps allow enough overlap form groups. Groups stand in
signature trees: a tree node has the OR of its members' token bitmaps and their range of sizes,
and a dual traversal drops pairs of tree nodes whose largest possible overlap is too small; pairs
left are compared. A group larger than a task takes is cut into blocks, and whatever the blocks
leave apart is traversed block against block, so that pairs exist only within tasks. Lists of a
rare shingle whose nodes lie in several groups pass such trees of bitmaps first, and groups with
members that may link become one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, dropped, mix, saved, word_hashes, word_spans

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Counters of shingles; their ranks, a byte each, are broadcast.
COUNTERS = 1 << 22
#: Rows (of a few numbers each) up to which the smaller side of a join with token sets is broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Vectors in which a task hands on its counters.
SLICES = 64
#: Nodes and shingles of a block, of which one task holds two at a time; larger groups are cut.
GROUP_NODES, GROUP_SHINGLES = 4000, 1_000_000
#: Shingles that blocks of cut groups may always have together in one round.
ROUND_SHINGLES = 16_000_000
#: Children of a tree node.
FANOUT = 16
#: Bits of the filter of documents whose sets are needed.
FILTER_BITS = 1 << 27
_FACTORS = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BATCH = 1 << 19


def shingles(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of width words; of fewer words, one of them all."""
    waiting: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        waiting.append((t or "").encode().lower())
        size += len(waiting[-1])
        if size >= BATCH or i == len(texts) - 1:
            yield from _shingles(waiting, width)
            waiting, size = [], 0


def _shingles(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    starts, ends = word_spans(data, IS_WORD)
    words = word_hashes(data, starts, ends)
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += words[k : k + n] * _FACTORS[k]
    total = mix(total)
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)])).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= width:
            yield np.unique(total[a : b - width + 1])
        elif b > a:
            yield mix((words[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_id(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(mix(mix(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])


def coarse(counts: np.ndarray) -> np.ndarray:
    """counts with only their 10 highest bits, so that there are at most some thousands of different ones."""
    low = np.maximum(np.frexp(counts.astype(np.float64))[1].astype(np.int64) - 10, 0)
    return counts >> low << low


def edges_of(values: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Edges of ranks for counters that have these values (ascending, above 0), each so many times: 192 quantiles, and finer steps above the 99th hundredth."""
    if not len(values):
        return np.zeros(0)
    met = np.cumsum(times)
    quantiles = values[np.searchsorted(met, np.append(np.linspace(0, 1, 192), 0.99) * met[-1]).clip(max=len(values) - 1)]
    return np.unique(np.concatenate([quantiles[:-1], np.geomspace(quantiles[-1], values[-1], 60)]))


def ranked(counts: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A byte for each counter that grows with its count."""
    return np.searchsorted(edges, counts, side="left").astype(np.uint8)


def rare(s: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The rarest of a set's shingles, so many that it shares one of them with every set of enough likeness.

    Of n shingles such a set has percent / 100 * n or more, and likewise of its own; were none of
    the first n - that + 1 of either common, the common ones would be too few. Equal ranks go by value.
    """
    order = (ranks[(s & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
    return s[np.argsort(order, kind="stable")[: len(s) - -(-percent * len(s) // 100) + 1]]


def width_of(most: int) -> int:
    """Words of 64 bits in the bitmaps of sets of no more than so many tokens."""
    return (1 << max(9, min(16, (16 * most - 1).bit_length()))) // 64


class Tree:
    """A signature tree over sets: FANOUT neighbours of the given order under each node.

    levels[0] has the sets, and each further level the nodes above: bits (OR of the bitmaps), lo and
    hi (sizes), excess (the most tokens that a set has beyond the bits that it fills), share (that
    of the bitmap's width which the widest map fills before it is repeated).
    """

    def __init__(self, bits: np.ndarray, size: np.ndarray, excess: np.ndarray, share: np.ndarray, order: np.ndarray, sets: list[np.ndarray] | None):
        self.members, self.sets = order, sets and [sets[i] for i in order]
        self.levels = [(bits[order], size[order], size[order], excess[order], share[order])]
        while len(self.levels[-1][0]) > 1 or len(self.levels) == 1:
            self.add_level()

    @classmethod
    def of_sets(cls, sets: list[np.ndarray], words: int) -> Tree:
        """Neighbours have the same smallest token, and so are likely alike."""
        bits = np.zeros((len(sets), words), np.uint64)
        for row, s in zip(bits, sets, strict=True):
            at = s & np.uint64(64 * words - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        size = np.array([len(s) for s in sets])
        return cls(bits, size, size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64), np.ones(len(sets)), np.lexsort((size, [s[0] for s in sets])), sets)

    @classmethod
    def of_bitmaps(cls, maps: list[np.ndarray], size: np.ndarray, words: int) -> Tree:
        """maps: bitmaps of words or a half, a quarter, ... of them, which are repeated; neighbours are alike in size."""
        excess = size - np.array([int(np.bitwise_count(x).sum()) for x in maps])
        share = np.array([len(x) / words for x in maps])
        return cls(np.array([np.tile(x, words // len(x)) for x in maps]), size, excess, share, np.argsort(size, kind="stable"), None)

    def add_level(self) -> None:
        bits, lo, hi, excess, share = self.levels[-1]
        at = np.arange(0, len(bits), FANOUT)
        self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(excess, at), np.maximum.reduceat(share, at)))


def may_link(a: tuple, b: tuple, percent: int) -> np.ndarray:
    """For each tree node of a and each of b, whether some member of the one may reach some member of the other."""
    lo_a, hi_a, excess_a, share_a = (v[:, None] for v in a[1:])
    lo_b, hi_b, excess_b, share_b = b[1:]
    need = -(-percent * (lo_a + lo_b) // (100 + percent))
    # common tokens lie in common bits, one in each but for those that share a bit with another; bits of repeated maps count once
    common = np.bitwise_count(a[0][:, None] & b[0][None]).sum(axis=2, dtype=np.int64) * np.maximum(share_a, share_b) + np.minimum(excess_a, excess_b)
    return (100 * hi_a >= percent * lo_b) & (100 * hi_b >= percent * lo_a) & (np.minimum(hi_a, hi_b) >= need) & (common >= need)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def tree_links(a: Tree, b: Tree, labels_a: np.ndarray, labels_b: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links (i, j) between the sets of two trees, or of one (a is b), that connect what all links do.

    labels name the component of each set, in the order in which the sets were given. Sets of equal
    labels are connected already and not compared; links found change the labels. Trees of bitmaps
    give links of all pairs that may link.
    """
    while len(a.levels) < len(b.levels):
        a.add_level()
    while len(b.levels) < len(a.levels):
        b.add_level()
    own_a, own_b = labels_a[a.members], labels_b[b.members]
    stack = [(len(a.levels) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        below = level - 1
        x, y = (slice(k * FANOUT, (k + 1) * FANOUT) for k in (i, j))
        if below == 0:
            apart = own_a[x, None] != own_b[None, y]
            if not apart.any():
                continue
        may = may_link(tuple(v[x] for v in a.levels[below]), tuple(v[y] for v in b.levels[below]), percent)
        if below == 0:
            may &= apart
        if a is b and i == j:
            may = np.triu(may, 1 if below == 0 else 0)
        # neighbours last, so that they come off the stack first
        for p, q in sorted(np.argwhere(may).tolist(), key=lambda v: -abs(v[0] - v[1]) if below else abs(v[0] - v[1])):
            p, q = p + i * FANOUT, q + j * FANOUT
            if below:
                stack.append((below, p, q))
            elif own_a[p] != own_b[q] and (a.sets is None or linked(a.sets[p], b.sets[q], percent)):
                yield int(a.members[p]), int(b.members[q])
                old, new = own_b[q], own_a[p]
                own_b[own_b == old] = new
                own_a[own_a == old] = new


def _mapped(docs: DataFrame, schema: str, width: int, one, last=None, wanted=None) -> DataFrame:
    """one: from a task's state, ids and sets of a batch to columns; last: from the state to those at the task's end; wanted: which ids."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            batch = batch.filter(wanted(batch.column(0))) if wanted else batch
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                yield pa.RecordBatch.from_arrays(one(state, part.column(0), shingles(part.column(1).to_pylist(), width)), names=names)
        if last and state:
            yield pa.RecordBatch.from_arrays(last(state), names=names)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def bitmap(s: np.ndarray) -> bytes:
    """A bit for each token, of as many as a power of two that is no less than twice the set's size.

    With fewer, sets that have nothing in common but a rare shingle may link often enough that their
    groups run together as the documents grow in number.
    """
    bits = 1 << max(6, (2 * len(s) - 1).bit_length())
    out = np.zeros(bits, np.uint8)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def pair_may_link(n: int, m: int, x: bytes, y: bytes, percent: int) -> bool:
    """Whether sets of these sizes and bitmaps may link: the bound of tree nodes for two single sets."""
    if 100 * min(n, m) < percent * max(n, m):
        return False
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    width = min(len(a), len(b))
    a, b = (v if len(v) == width else np.bitwise_or.reduce(v.reshape(-1, width), axis=0) for v in (a, b))
    excess = min(n - int(np.bitwise_count(a).sum()), m - int(np.bitwise_count(b).sum()))
    return int(np.bitwise_count(a & b).sum()) + excess >= -(-percent * (n + m) // (100 + percent))


def nodes_of(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, node, bits) of each row, and the rank of each counter of shingles; node names a set, null if that is empty."""

    def one(state, ids, sets):
        made = []
        counts, seen = state.setdefault("counts", np.zeros(COUNTERS, np.uint32)), state.setdefault("seen", set())
        for s in sets:
            made.append((len(s), set_id(s), bitmap(s)) if len(s) else (0, None, None))
            if len(s) and made[-1][1] not in seen:  # copies of a set in one task count once
                seen.add(made[-1][1])
                np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        return [ids, *(pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))), pa.array([False] * len(ids))]

    def last(state):
        # byte by byte, so that the high ones, mostly zero, take no room when compressed
        slices = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in state["counts"].reshape(SLICES, -1)]
        none = pa.nulls(SLICES, pa.int64())
        return [none, none, pa.array(range(SLICES), pa.int64()), pa.array(slices, pa.binary()), pa.array([True] * SLICES)]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                sums[k] = sums.get(k, np.int64(0)) + np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        for k, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["k", "sums"])

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(1):
                found = np.unique(coarse(np.frombuffer(x.as_buffer(), np.int64)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found], names=["value", "times"])

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [ranked(np.frombuffer(x.as_buffer(), np.int64), edges).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["k", "ranks"])

    rows = saved(_mapped(docs, "doc_id bigint, n bigint, node bigint, bits binary, counter boolean", width, one, last), "sets")
    # the sums stay in tasks; the driver gets the different counts, and then a byte for each counter
    sums = saved(rows.where("counter").select("node", "bits").repartition("node").mapInArrow(added, "k bigint, sums binary"), "counts")
    met = sums.mapInArrow(values, "value bigint, times bigint").where("value > 0").groupBy("value").agg(F.sum("times").alias("times")).sort("value").toArrow()
    edges = edges_of(met.column(0).to_numpy(), met.column(1).to_numpy())
    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint8)
    for r in sums.mapInArrow(ranks, "k bigint, ranks binary").toLocalIterator():
        out[r["k"]] = np.frombuffer(r["ranks"], np.uint8)
    dropped(sums)
    return rows.where("NOT counter").drop("counter"), out.ravel()


def shared_parts(docs: DataFrame, ranks: np.ndarray, width: int, percent: int) -> DataFrame:
    """(key, node, least) of the rare shingles that several nodes have; least is the smallest of these."""
    all_ranks = docs.sparkSession.sparkContext.broadcast(ranks)

    def one(state, ids, sets):
        keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for s in sets:
            if len(s) and (h := set_id(s)) not in state:  # copies of a set in one task give its keys once
                state[h] = None
                keys.append(rare(s, all_ranks.value, percent))
                nodes.append(np.full(len(keys[-1]), h))
        return [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes))]

    # dealt out by key once; both sides of the join use that, and neither holds the rows of a key together
    rows = _mapped(docs, "key bigint, node bigint", width, one).repartition("key")
    several = rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least != most").drop("most")
    return saved(rows.join(several, "key").select("key", "node", "least"), "parts")


def _allowed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs of nodes (a, b) whose sizes and bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            yield batch.filter(pa.array([pair_may_link(*r, percent) for r in rows], pa.bool_())).select(["a", "b"])

    # sizes first, so that the bitmaps of most pairs are never moved
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")), x)
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(x), F.col("data").alias(f"bits_{x}")), x)
    return pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def _tokens(docs: DataFrame, sets: DataFrame, width: int) -> DataFrame:
    """(node, data) of the nodes of sets (node, doc_id), data being the sorted hashes in a row.

    The documents are found by a filter of FILTER_BITS bits, which has a fixed size and may let more
    pass; the join on the node is exact.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = sets.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("v")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column(0).to_numpy()] = words.column(1).to_numpy()
    of_docs = docs.sparkSession.sparkContext.broadcast(bits)
    rows = docs.withColumn("text", F.col("text").cast("string")).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL").select("doc_id", "text", place.alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((of_docs.value[p >> 6] >> (p & 63)) & 1 == 1))
            for i in range(0, batch.num_rows, 500):
                sets = [s for s in shingles(batch.column(1).slice(i, 500).to_pylist(), width) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "data"])

    found = rows.mapInArrow(run, "node bigint, data binary").join(_small(sets.select("node")), "node", "left_semi")
    return saved(found.groupBy("node").agg(F.first("data").alias("data")), "tokens")


def _compared(rows: DataFrame, data: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Links (a, b) of nodes within the blocks of rows (g, i, j, side, node, n, label); if not exact, of nodes that may link.

    data has the tokens of each node, or their bitmaps if not exact. A block (g, i, j) that has rows
    of both sides is traversed one side against the other, another one with itself; sorted blocks
    pass through a task one after the other.
    """

    def traversed(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        size = np.array([r[2] for r in rows])
        words = width_of(max(map(len, sets))) if exact else max(map(len, sets))
        tree = lambda k, m: Tree.of_sets(sets[k:m], words) if exact else Tree.of_bitmaps(sets[k:m], size[k:m], words)
        labels = np.array([r[3] for r in rows])
        cut = next((k for k, r in enumerate(rows) if r[0]), 0)
        if cut:
            found = tree_links(tree(0, cut), tree(cut, len(sets)), labels[:cut], labels[cut:], percent)
        else:
            found = tree_links(one := tree(0, len(sets)), one, labels, labels, percent)
        for x, y in found:
            yield rows[x][1], rows[cut + y][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        block, held = None, []
        for batch in batches:
            for *at, side, node, n, label, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != block:
                    if len(held) > 1:
                        links += traversed(held)
                    block, held = at, []
                held.append((side, node, n, label, x))
            yield as_rows(links)
            links = []
        if len(held) > 1:
            links += traversed(held)
        yield as_rows(links)

    def as_rows(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = data.join(_small(rows), "node").select("g", "i", "j", "side", "node", "n", "label", "data")
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side").mapInArrow(run, "a bigint, b bigint")


def _small(rows: DataFrame) -> DataFrame:
    """rows to be broadcast, if they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def links_within(members: DataFrame, data: DataFrame, percent: int, exact: bool = True) -> DataFrame:
    """Links (a, b) of nodes within each group of members (g, node, n, label) that connect what all do; equal labels are connected already.

    Groups that exceed a block are cut. Each block is joined with itself, then one member of each of
    its components with those of the others. Members outside of a group's largest component are
    joined, block by block, with all blocks of the group after that: of two members that still have
    different components one at least is such a member. These blocks pass in rounds.
    """
    placed = saved(_placed(members), "placed")
    own = lambda rows: rows.select("g", F.col("chunk").alias("i"), F.lit(-1).alias("j"), F.lit(0).alias("side"), "node", "n", "label")
    links = saved(_compared(own(placed), data, percent, exact), "links")
    large = placed.where("chunks > 1")
    if large.isEmpty():
        return links
    one = _relabelled(large, links).groupBy("g", "label").agg(F.min(F.struct("node", "n")).alias("r")).select("g", "label", "r.*")
    links = saved(links.union(_compared(own(_placed(one)), data, percent, exact)), "links")
    now = saved(_relabelled(large, links), "now")
    most = now.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("g").agg(F.max_by("label", F.struct("c", "label")).alias("most"))
    outside = now.join(most, "g").where("label != most").drop("most")
    outside = saved(_placed(outside.withColumn("home", F.col("chunk")).drop("chunk", "chunks")).join(now.select("g", F.col("chunks").alias("all")).distinct(), "g"), "outside")
    times = outside.groupBy("g").agg(F.max("chunks").alias("times"))
    stay = now.join(times, "g").select("g", F.col("chunk").alias("i"), F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("j"), F.lit(0).alias("side"), "node", "n", "label")
    visit = outside.select("g", F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("i"), F.col("chunk").alias("j"), F.lit(1).alias("side"), "node", "n", "label", "home")
    blocks = stay.union(visit.where("i != home").drop("home"))
    # dealt out in rounds, so that the disk holds no more of them at a time than the groups themselves take
    passing = now.join(times, "g").select((F.col("n") * F.col("times")).alias("n")).union(outside.select(F.col("n") * F.col("all")))
    rounds = -(-(passing.agg(F.sum("n")).first()[0] or 0) // max(now.agg(F.sum("n")).first()[0], ROUND_SHINGLES))
    for k in range(rounds):
        own_round = F.pmod(F.xxhash64("g", "i", "j"), F.lit(rounds)) == k
        links = links.union(saved(_compared(blocks.where(own_round), data, percent, exact), "links"))
    return links


def _placed(members: DataFrame) -> DataFrame:
    """members (g, node, n) with the chunk of their group that they belong to."""
    members = members.drop("chunk", "chunks")
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_NODES, F.sum("n") / GROUP_SHINGLES)).cast("int").alias("chunks")
    return members.join(members.groupBy("g").agg(chunks), "g").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows (g, node, n, label) of groups with several labels; of groups with equal nodes those of one."""
    mixed = rows.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h")).where("lo != hi")
    return saved(rows.join(mixed.groupBy("c", "h", "lo", "hi").agg(F.min("g").alias("g")).select("g"), "g"), "lists")


def _by_size(rows: DataFrame, percent: int) -> DataFrame:
    """rows (g, node, n, label) with each group cut into overlapping classes of sizes, so that two nodes whose sizes allow a link are together in one.

    Sizes of a class span a little more than the largest ratio of two that link, which thus lie in
    the same class or in neighbouring ones, and a node stands with its class and the next lower one.
    """
    step = max(math.log(100 / percent) * 1.000001, 1e-9)
    at = F.floor(F.log("n") / step)
    return rows.withColumn("class", F.explode(F.array(at, at + 1))).withColumn("g", F.xxhash64("g", "class")).drop("class")


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows (node, label) with the labels after links."""
    names = rows.select("node", F.col("label").alias("b")).where("node != b").select(F.col("node").alias("a"), "b")
    found = components(names.union(links)).withColumnRenamed("component", "new")
    return rows.join(found, "node", "left").withColumn("label", F.coalesce("new", "label")).drop("new")


def connected(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row of docs: doc_id, n_shingles and component_id, the smallest doc_id that links lead to.

    Two documents link when their sets of width-word shingles (of fewer words, the whole sequence
    as one; A-Z lower-cased, words between white space) have a Jaccard likeness of percent / 100 or
    more. A text that is null or has no words has an empty set and is linked with nothing. Repeated
    rows stay; a row without doc_id takes the component of the others, or null. Jobs run when this
    is called; only the last join is left to the result.

    Of a group of N different near copies, S of them outside of its largest component after the
    first rounds, N + N * ceil(S / GROUP_NODES) + S * ceil(N / GROUP_NODES) rows pass through tasks.
    """
    nodes, ranks = nodes_of(docs, width)
    filled = nodes.where("node IS NOT NULL")
    parts = shared_parts(docs, ranks, width, percent)
    sets = filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("bits").alias("data")).where("doc_id IS NOT NULL")
    sets = saved(sets.join(parts.select("node").distinct(), "node", "left_semi"), "members")
    others = parts.where("node != least")
    near = saved(_allowed(others.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct(), sets, percent), "near")
    # lists of which the nodes besides the smallest reach over several groups, each different one once
    rooted = _relabelled(others.join(sets.select("node", "n"), "node").select(F.col("key").alias("g"), "node", "n", F.col("node").alias("label")), near)
    whole = _mixed(rooted)
    lists = _mixed(_by_size(whole, percent))
    more = near if lists.isEmpty() else near.union(links_within(lists, sets.select("node", "data"), percent, exact=False))
    groups = saved(components(more).join(sets.select("node", "n", "doc_id"), "node").select(F.col("component").alias("g"), "node", "n", F.col("node").alias("label"), "doc_id"), "groups")
    tokens = _tokens(docs, groups, width)
    links = links_within(groups.drop("doc_id"), tokens, percent)
    found = saved(components(links), "components")
    first = filled.groupBy("node").agg(F.min("doc_id").alias("first"))
    named = first.join(found, "node").select("node", "component", "first")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = saved(named.join(least, "component").select("node", "component_id"), "named")
    dropped(parts, sets, tokens, near, more, whole, lists, groups, links, found)
    alone = first.join(named, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    return nodes.join(alone, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs without near copies: of each component the row of its smallest doc_id stays. Rows without doc_id and with empty texts stay."""
    copies = connected(docs, width, percent).where("doc_id != component_id").select(F.col("doc_id").alias("copy_id")).distinct()
    return docs.join(copies, docs["doc_id"] == copies["copy_id"], "left_anti")
