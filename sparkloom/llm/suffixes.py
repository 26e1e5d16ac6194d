"""Removal of byte strings that stand in an earlier document, by a distributed merge sort of suffixes.

Every string of LENGTH bytes has an anchor, the k-gram of least hash in it, and so equal strings
have equal anchors. A first exchange of sorted, delta-coded hashes leaves the anchors whose k-gram
stands in several documents. The text of all strings that an anchor stands for, some 60 bytes, is
a suffix of its document as far as it matters: these are sorted in runs, front-coded, dealt out by
key range and merged by loser trees that know how long a prefix each run's head shares with the
last winner, so that no known prefix is compared again. In the merged order equal texts are
neighbours; all but the smallest document lose theirs. Where a k-gram has several surroundings,
the smallest documents' strings of LENGTH bytes themselves are sorted and merged in the same way,
after an exchange of hashes has dropped those that stand in one document only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BYTE_VALUES, dropped, mix, powers, saved

LENGTH = 50
#: Bytes of an anchor's k-gram: small, so that anchors are rare; large, so that few are shared by chance.
GRAM = 32
#: Places of a k-gram in a string of LENGTH bytes, less one.
REACH = LENGTH - GRAM
#: Bytes of a suffix in the first merge: the text, its length and the anchor's place in it.
WIDTH = LENGTH + REACH + 2
#: Bytes of text that are looked at together, anchors of a run of hashes, suffixes of a sorted run.
BATCH, RUN_HASHES, RUN = 1 << 19, 1_000_000, 100_000
#: Bits of hashes that are exchanged; equal ones by chance only add candidates.
BITS = 48
SALT = np.uint64(0xA5A5F00D)
_PLACE = np.uint64((1 << 24) - 1)
#: Windows looked at together, fewer than _PLACE can number.
_PIECE = 1 << 23

HASHES = "r int, hashes binary, docs binary, codes binary"
SUFFIXES = "r int, shared binary, rest binary, docs binary, starts binary, ends binary"


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts that follow each other in data, ends being where each ends: places, hashes of the k-grams, and the first and last start of the strings that each stands for."""
    n = len(data)
    if n < LENGTH:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2)
    gram = window_hashes(data, GRAM)
    limit = np.repeat(ends, np.diff(ends, prepend=0))
    found = []
    for begin in range(0, n - LENGTH + 1, _PIECE):
        g = gram[begin : begin + _PIECE + REACH]
        # the least of REACH + 1 neighbours, by doubling; of equal hashes the last counts, which the low bits see to
        low, have = (g & ~_PLACE) | (_PLACE - np.arange(len(g), dtype=np.uint64)), 1
        while have <= REACH:
            step = min(have, REACH + 1 - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        found.append((_PLACE - (low & _PLACE)).astype(np.int64) + begin)
    of_window = np.concatenate(found)
    start = np.flatnonzero(np.arange(len(of_window)) + LENGTH <= limit[: len(of_window)])
    a = of_window[start]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    last = np.append(first[1:], len(a)) - 1
    return a[first], gram[a[first]], start[first], start[last]


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each string of width bytes."""
    n = len(data)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1])


def planes(x: np.ndarray) -> bytes:
    """Integers byte by byte, all lowest bytes first, so that high ones compress well; bytes that are zero in all are left out."""
    n = 8 if len(x) and int(x.min()) < 0 else (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return len(x).to_bytes(8, "little") + np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def unplanes(b) -> np.ndarray:
    data = np.frombuffer(b, np.uint8)
    n = int(data[:8].view("<i8")[0])
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : (len(data) - 8) // n] = data[8:].reshape(-1, n).T
    return out.view("<i8").ravel()


def _buffers(table: pa.Table, *names: str) -> Iterator[tuple]:
    """The binary values of each row (None for null), without copies."""
    return zip(*([x.as_buffer() for x in table.column(c)] for c in names), strict=True)


def _groups(keys: np.ndarray) -> np.ndarray:
    """Where groups of equal neighbours begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def in_several(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], ranges: int) -> DataFrame:
    """(doc_id, code) of the hashes that several documents have.

    hashes makes of a batch of rows (hashes, doc_ids, codes), rows of a document together and codes
    not negative. Tasks sort them in runs. Of a hash that a run has in several documents only one
    goes to the others, marked so; the task knows already that the rest is shared.
    """

    def coded(parts: list[tuple]) -> pa.RecordBatch:
        h, doc, code = (np.concatenate(x) for x in zip(*parts, strict=True))
        h >>= np.uint64(64 - BITS)
        order = np.argsort(h, kind="stable")
        h, doc, code = h[order], doc[order], code[order]
        at = _groups(h)
        size = np.diff(np.append(at, len(h)))
        several = np.repeat(np.logical_or.reduceat(doc != np.repeat(doc[at], size), at), size)
        told = np.zeros(len(h), bool)
        told[at] = several[at]
        known = several & ~told
        known_doc, known_code = doc[known], code[known]
        out = []
        for k in range(0, len(known_doc), 20_000):  # to any range, as they need no other
            p = slice(k, k + 20_000)
            out.append((hash((int(known_doc[k]), k)) % ranges, None, planes(known_doc[p]), planes(known_code[p])))
        h, doc, code = h[~known], doc[~known], 2 * code[~known] + told[~known]
        cuts = [0, *np.searchsorted(h, np.array([-(-(k << BITS) // ranges) for k in range(1, ranges)], np.uint64)).tolist(), len(h)]
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                out.append((r, planes(np.diff(h[a:b], prepend=np.uint64(0))), planes(doc[a:b]), planes(code[a:b])))
        return _batch(list(zip(*out, strict=True)), HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0
        for batch in batches:
            for part in hashes(batch):
                parts.append(part)
                size += len(part[0])
                if size >= RUN_HASHES:
                    yield coded(parts)
                    parts, size = [], 0
        if size:
            yield coded(parts)

    def counted(table: pa.Table) -> pa.Table:
        docs, codes, held = [], [], []
        for h, d, c in _buffers(table, "hashes", "docs", "codes"):
            if h is None:
                docs.append(unplanes(d))
                codes.append(unplanes(c))
            else:
                held.append((np.cumsum(unplanes(h)), unplanes(d), unplanes(c)))
        if held:
            h, d, c = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            h, d, c = h[order], d[order], c[order]
            at = _groups(h)
            size = np.diff(np.append(at, len(h)))
            shared = np.repeat(np.logical_or.reduceat((d != np.repeat(d[at], size)) | (c & 1 == 1), at), size)
            docs.append(d[shared])
            codes.append(c[shared] >> 1)
        return pa.table([np.concatenate(docs), np.concatenate(codes)], names=["doc_id", "code"])

    return rows.mapInArrow(run, HASHES).groupBy("r").applyInArrow(counted, "doc_id bigint, code bigint")


def _texts(ids: list[int], texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, texts in a row, where each ends) of a few texts at a time."""
    begin = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BATCH or k == len(texts) - 1:
            part = texts[begin : k + 1]
            yield np.array(ids[begin : k + 1], np.int64), np.frombuffer(b"".join(part), np.uint8), np.cumsum([len(x) for x in part])
            begin, size = k + 1, 0


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The values of all lists in a row, and where each list's begin (with the end at last); null is an empty list."""
    return lists.flatten(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)


def shared_anchors(docs: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, code) of anchors whose k-gram stands in several documents; code has the place and how far the strings that it stands for begin before it, at most and at least."""

    def hashes(batch: pa.RecordBatch) -> Iterator[tuple]:
        for ids, data, ends in _texts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, g, first, last = anchors(data, ends)
            doc = np.searchsorted(ends, a, side="right")
            # anchors have small hashes, so they are mixed anew to fill all ranges alike
            yield mix(g + SALT), ids[doc], ((a - (ends[doc] - np.diff(ends, prepend=0)[doc])) << 10) | ((a - first) << 5) | (a - last)

    return in_several(docs.select("doc_id", F.col("text").cast("binary")), hashes, ranges)


def front_coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows of bytes as the lengths of the prefixes shared with the one before, and the rests in a row."""
    same = np.zeros(len(x), np.int64)
    differ = x[1:] != x[:-1]
    same[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return same.astype(np.uint8), x[np.arange(x.shape[1]) >= same[:, None]]


def decoded(same: np.ndarray, rest: np.ndarray, width: int) -> np.ndarray:
    x = np.zeros((len(same), width), np.uint8)
    x[np.arange(width) >= same[:, None]] = rest
    rows = np.arange(len(same))
    for k in range(width):  # a byte that is shared stands in the last row that has its own
        x[:, k] = x[np.maximum.accumulate(np.where(same <= k, rows, 0)), k]
    return x


def merged(runs: list[tuple[list[int], list[bytes]]], width: int) -> tuple[list[int], list[int]]:
    """The order of the rows of all runs, numbered through, and the prefix that each shares with the one before in it.

    Runs are (prefixes shared with the row before, rows). A loser tree: every head carries the
    length that it shares with the last winner. Of two heads the one that shares more is smaller,
    and only of equal lengths are bytes compared, from there on.
    """
    k = len(runs)
    base = np.cumsum([0, *(len(r[1]) for r in runs)]).tolist()
    at = [0] * k
    head: list[bytes | None] = [r[1][0] if r[1] else None for r in runs]
    lcp = [0 if h is not None else -1 for h in head]
    losers = [-1] * k

    def beats(i: int, j: int) -> bool:
        """Whether head i, of the same length as head j, comes first; the loser's length is set to what it shares with the winner."""
        x, y, n = head[i], head[j], lcp[i]
        if x is None or y is None:
            return y is None
        if x == y:
            lcp[j] = width
            return True
        while x[n] == y[n]:
            n += 1
        if x[n] < y[n]:
            lcp[j] = n
            return True
        lcp[i] = n
        return False

    def build(node: int) -> int:
        if node >= k:
            return node - k
        i, j = build(2 * node), build(2 * node + 1)
        first = lcp[i] > lcp[j] or (lcp[i] == lcp[j] and beats(i, j))
        losers[node] = j if first else i
        return i if first else j

    order, shared = [], []
    w = build(1) if k > 1 else 0
    while k and lcp[w] >= 0:
        order.append(base[w] + at[w])
        shared.append(lcp[w])
        at[w] += 1
        same, rows = runs[w]
        if at[w] < len(rows):
            head[w], lcp[w] = rows[at[w]], same[at[w]]
        else:
            head[w], lcp[w] = None, -1
        node = (w + k) >> 1
        while node:
            o = losers[node]
            if lcp[o] > lcp[w] or (lcp[o] == lcp[w] and beats(o, w)):
                losers[node], w = w, o
            node >>= 1
    return order, shared


def unions(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents with those that touch made one."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    step = int(end.max()) + 1
    shift = step * np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))  # spans of different documents can't touch
    reach = np.maximum.accumulate(end + shift)
    at = np.flatnonzero(np.concatenate([[True], (start + shift)[1:] > reach[:-1]]))
    return doc[at], start[at], np.maximum.reduceat(end, at)


def bounds_of(docs: DataFrame, ranges: int) -> np.ndarray:
    """Keys of 16 bytes that cut the suffixes into about so many ranges, from texts of 64 documents a range."""
    data = F.col("text").cast("binary")
    at = 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.octet_length("text") - 16, F.lit(1)))
    some = docs.where(F.octet_length("text") >= 16).select(data.substr(at.cast("int"), F.lit(16)).alias("k"), F.xxhash64("doc_id", F.lit(1)).alias("h"))
    keys = sorted(bytes(r["k"]) for r in some.groupBy(F.pmod("h", F.lit(64 * ranges)).alias("b")).agg(F.min_by("k", "h").alias("k")).collect())
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return np.array(cuts, "S16")


def sorted_and_merged(rows: DataFrame, suffixes: Callable[[pa.RecordBatch], Iterator[tuple]], width: int, sizes: Callable, bounds: np.ndarray, schema: str, of_first: Callable) -> DataFrame:
    """Rows of schema: spans (doc_id, start, end) of the suffixes that also stand in a smaller document, and what of_first makes of all the others.

    suffixes makes of a batch of rows (bytes as rows of a width, doc_ids, starts), sizes of such
    bytes how long each text is; of_first takes the spans and (bytes, doc_ids, starts, ends). Tasks
    sort runs of RUN suffixes or more; of equal ones of a run only the smallest
    document's go on, and the spans of the rest are known.
    """

    def coded(parts: list[tuple]) -> pa.RecordBatch:
        x, doc, start = (np.concatenate(v) for v in zip(*parts, strict=True))
        order = np.argsort(np.ascontiguousarray(x).view(f"S{width}").ravel(), kind="stable")
        x, doc, start = x[order], doc[order], start[order]
        at = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))
        first = doc == np.repeat(np.minimum.reduceat(doc, at), np.diff(np.append(at, len(doc))))
        out = []
        if not first.all():
            d, s, e = unions(doc[~first], start[~first], start[~first] + sizes(x[~first]))
            for k in range(0, len(d), 20_000):
                p = slice(k, k + 20_000)
                out.append((hash((int(d[k]), k)) % (len(bounds) + 1), None, None, planes(d[p]), planes(s[p]), planes(e[p])))
        x, doc, start = x[first], doc[first], start[first]
        compressor = zstandard.ZstdCompressor(level=1)
        of_range = np.searchsorted(bounds, np.ascontiguousarray(x[:, :16]).view("S16").ravel(), side="right")
        cuts = [0, *np.flatnonzero(np.diff(of_range)) + 1, len(x)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            same, rest = front_coded(x[a:b])
            out.append((int(of_range[a]), same.tobytes(), compressor.compress(rest.tobytes()), planes(doc[a:b]), planes(start[a:b]), None))
        return _batch(list(zip(*out, strict=True)), SUFFIXES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0
        for batch in batches:
            for part in suffixes(batch):
                parts.append(part)
                size += len(part[0])
                if size >= RUN:
                    yield coded(parts)
                    parts, size = [], 0
        if size:
            yield coded(parts)

    def merge(table: pa.Table) -> pa.Table:
        spans, held, rows = [], [], []
        for same, rest, doc, start, end in _buffers(table, "shared", "rest", "docs", "starts", "ends"):
            if same is None:
                spans.append([unplanes(v) for v in (doc, start, end)])
                continue
            same = np.frombuffer(same, np.uint8)
            x = decoded(same.astype(np.int64), np.frombuffer(zstandard.ZstdDecompressor().decompress(rest), np.uint8), width)
            data = x.tobytes()
            rows.append((same.tolist(), [data[i : i + width] for i in range(0, len(data), width)]))
            held.append((x, unplanes(doc), unplanes(start)))
        others = None
        if held:
            order, shared = merged(rows, width)
            x, doc, start = (np.concatenate(v)[order] for v in zip(*held, strict=True))
            end = start + sizes(x)
            at = np.flatnonzero(np.array(shared) < width)
            first = doc == np.repeat(np.minimum.reduceat(doc, at), np.diff(np.append(at, len(doc))))
            spans.append([v[~first] for v in (doc, start, end)])
            others = [v[first] for v in (x, doc, start, end)]
        pa.default_memory_pool().release_unused()
        return of_first(unions(*(np.concatenate(v) for v in zip(*spans, strict=True))) if spans else [np.zeros(0, np.int64)] * 3, others)

    return rows.mapInArrow(run, SUFFIXES).groupBy("r").applyInArrow(merge, schema)


SPANS = "doc_id bigint, start bigint, end bigint"
CLASSES = f"{SPANS}, gram bigint, data binary"


def _surroundings(texts: DataFrame, bounds: np.ndarray) -> DataFrame:
    """CLASSES of texts (doc_id, text, codes): spans that go, and with gram and data the smallest documents' anchors, data being their text."""

    def suffixes(batch: pa.RecordBatch) -> Iterator[tuple]:
        codes, at = _flat(batch.column(2))
        k = 0
        for ids, data, ends in _texts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = at[k : k + len(ids) + 1]
            k += len(ids)
            doc, code = np.repeat(np.arange(len(ids)), np.diff(own)), codes.to_numpy()[own[0] : own[-1]]
            place, most, least = code >> 10, (code >> 5) & 31, code & 31
            start, end = place - most, place - least + LENGTH
            size = np.diff(ends, prepend=0)
            fits = (start >= 0) & (end <= size[doc])  # all do where a doc_id has one text
            doc, start, end, most = doc[fits], start[fits], end[fits], most[fits]
            if not len(doc):
                continue
            padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
            begin = ends[doc] - size[doc] + start
            x = np.zeros((len(doc), WIDTH), np.uint8)
            x[:, :-2] = padded[begin[:, None] + np.arange(WIDTH - 2)]
            x[:, :-2][np.arange(WIDTH - 2) >= (end - start)[:, None]] = 0
            x[:, -2], x[:, -1] = end - start, most + 1
            yield x, ids[doc], start

    def of_first(spans, others) -> pa.Table:
        doc, start, end = spans
        gram, data = pa.nulls(len(doc), pa.int64()), pa.nulls(len(doc), pa.binary())
        if others:
            x, d, s, e = others
            place = x[:, -1].astype(np.int64) - 1
            grams = x[np.arange(len(x))[:, None], place[:, None] + np.arange(GRAM)]
            hashes = window_hashes(grams.ravel(), GRAM)[::GRAM].view(np.int64)
            doc, start, end = (np.concatenate(v) for v in ((doc, d), (start, s), (end, e)))
            gram = pa.concat_arrays([gram, pa.array(hashes)])
            data = pa.concat_arrays([data, pa.array([row.tobytes() for row in x], pa.binary())])
        return pa.table([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(end, pa.int64()), gram, data], names=[f.split()[0] for f in CLASSES.split(", ")])

    return sorted_and_merged(texts, suffixes, WIDTH, lambda x: x[:, -2].astype(np.int64), bounds, CLASSES, of_first)


def _windows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (doc_id, start, data): their bytes, and for each string of LENGTH bytes the row, its doc_id and its place in data."""
    x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, WIDTH)
    n = x[:, -2].astype(np.int64) - LENGTH + 1
    row = np.repeat(np.arange(len(x)), n)
    return x, row, batch.column(0).to_numpy()[row], np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _strings(several: DataFrame, bounds: np.ndarray, ranges: int) -> DataFrame:
    """Spans of the strings of LENGTH bytes of several (doc_id, start, data) that also stand in a smaller document."""

    def hashes(batch: pa.RecordBatch) -> Iterator[tuple]:
        for k in range(0, batch.num_rows, 10_000):
            part = batch.slice(k, 10_000)
            x, row, doc, place = _windows(part)
            h = window_hashes(x.ravel(), LENGTH)[row * WIDTH + place]
            yield h, doc, (part.column(1).to_numpy()[row] << 6) | place

    found = in_several(several, hashes, ranges)
    found = found.groupBy("doc_id", F.shiftright("code", 6).alias("start")).agg(F.bit_or(F.expr("shiftleft(1L, cast(code & 63 AS int))")).alias("places"))
    rows = several.join(found, ["doc_id", "start"])

    def suffixes(batch: pa.RecordBatch) -> Iterator[tuple]:
        for k in range(0, batch.num_rows, 10_000):
            part = batch.slice(k, 10_000)
            x, row, doc, place = _windows(part)
            wanted = (part.column(3).to_numpy()[row] >> place) & 1 == 1
            row, doc, place = row[wanted], doc[wanted], place[wanted]
            yield x[row[:, None], place[:, None] + np.arange(LENGTH)], doc, part.column(1).to_numpy()[row] + place

    def of_first(spans, others) -> pa.Table:
        return pa.table([pa.array(v, pa.int64()) for v in spans], names=["doc_id", "start", "end"])

    return sorted_and_merged(rows.select("doc_id", "start", "data", "places"), suffixes, LENGTH, lambda x: LENGTH, bounds, SPANS, of_first)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def removal(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans): spans, an array of (start, end), of bytes covered by strings that also start in a smaller document; null if none. Jobs run when this is called."""
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = bounds_of(docs, 2 * ranges)
    found = saved(shared_anchors(docs, ranges), "anchors")  # written, so that its exchange is gone before the texts move
    places = found.groupBy("doc_id").agg(F.collect_set("code").alias("codes"))
    classes = saved(_surroundings(docs.join(places, "doc_id").select("doc_id", F.col("text").cast("binary"), "codes"), bounds), "classes")
    dropped(found)
    firsts = classes.where("data IS NOT NULL")
    several = firsts.groupBy("gram").agg(F.min(F.xxhash64("data")).alias("lo"), F.max(F.xxhash64("data")).alias("hi")).where("lo != hi").select("gram")
    several = saved(firsts.join(several, "gram").select("doc_id", "start", "data"), "several")
    strings = saved(_strings(several, bounds, ranges), "strings")
    dropped(several)
    spans = classes.where("data IS NULL").select("doc_id", "start", "end").union(strings)
    return docs.join(spans.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "doc_id", "left")


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of LENGTH bytes that covers it also
    starts in a document of a smaller doc_id; strings are those of the input, and matches never cross
    documents. Repeated rows of one doc_id don't remove each other; should they have different texts,
    spans found in one are removed from all, as far as they reach. Rows without doc_id are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            spans, cut = _flat(batch.column(2))
            start, end = (spans.field(k).to_numpy() for k in (0, 1))
            for k, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)):
                data, own = np.frombuffer(text.as_buffer(), np.uint8), slice(cut[k], cut[k + 1])
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, np.minimum(start[own], len(data)), 1)
                np.add.at(edge, np.minimum(end[own], len(data)), -1)
                gone = np.cumsum(edge[:-1]) > 0
                n_spans = int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=np.int8(0)) == 1))
                out.append((doc_id, len(data), int(gone.sum()), n_spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            if out:
                yield _batch(list(zip(*out, strict=True)), RESULT)

    return removal(docs).select("doc_id", F.col("text").cast("binary"), "spans").mapInArrow(run, RESULT)
