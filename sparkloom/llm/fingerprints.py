"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into phrases by deterministic coin tossing, phrases get names by content,
and the sequence of names is cut again. Where a phrase begins depends only on some symbols around
it, so equal substrings have the same phrases inside, wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BYTE_VALUES, mix

#: Levels of phrases; those of the last, of some 30 bytes each, make the fingerprint.
LEVELS = 3
#: Bins of a fingerprint, each with 16 bits of its smallest phrase name.
BINS = 64
EMPTY = 0xFFFF
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are parsed together.
BATCH = 1 << 19
_LOWEST = np.array([0, *((i & -i).bit_length() - 1 for i in range(1, 256))], np.uint8)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which a symbol differs from the one before, plus that bit; neighbours stay different."""
    d = x[1:] ^ x[:-1]
    out = np.empty(len(x), np.uint8)
    if x.dtype == np.uint8:
        low = _LOWEST[d]
        out[1:] = 2 * low + ((x[1:] >> low) & 1)
    else:
        low = np.bitwise_count((d & -d) - np.uint64(1)).astype(np.uint64)
        out[1:] = 2 * low.astype(np.uint8) + ((x[1:] >> (low & np.uint64(63))) & np.uint64(1)).astype(np.uint8)
    at = np.flatnonzero(first)
    out[at] = (x[at] & x.dtype.type(1)).astype(np.uint8)
    return out


def _cut(x: np.ndarray, names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the next level and which of them begin a text. x: symbols (bytes, or the names themselves)."""
    # equal symbols in a row become one that knows their number
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | first[1:]
    at = np.flatnonzero(new)
    size = np.diff(at, append=len(x))
    x, names, first = x[at], names[at], first[at]
    many = size > 1
    names = names.copy()
    names[many] = mix(names[many] + size[many].astype(np.uint64) * _STEP)
    label = x
    for _ in range(2 if x.dtype == np.uint8 else 3):
        label = _toss(label, first)
    # a phrase begins at each local minimum of the labels
    least = np.zeros(len(x), bool)
    if len(x) > 2:
        least[1:-1] = (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:]) & ~first[2:]
    starts = np.flatnonzero(least | first)
    place = np.arange(len(x)) - np.repeat(starts, np.diff(starts, append=len(x)))
    value = mix(names + place.astype(np.uint64) * _STEP)
    return mix(np.add.reduceat(value, starts)), first[starts]


def bins(texts: list[bytes]) -> np.ndarray:
    """An array of BINS values for each text."""
    out = np.full((len(texts), BINS), EMPTY, np.uint16)
    full = [i for i, t in enumerate(texts) if t]
    at = 0
    while at < len(full):
        group, size = [], 0
        while at < len(full) and (not group or size + len(texts[full[at]]) <= BATCH):
            group.append(full[at])
            size += len(texts[full[at]])
            at += 1
        data = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        first = np.zeros(len(data), bool)
        first[np.cumsum([0, *(len(texts[i]) for i in group[:-1])])] = True
        names, first = _cut(data, BYTE_VALUES[data], first)
        for _ in range(LEVELS - 1):
            names, first = _cut(names, names, first)
        low = np.full(len(group) * BINS, np.uint64(2**64 - 1))
        np.minimum.at(low, (np.cumsum(first) - 1) * BINS + (names >> np.uint64(58)).astype(np.int64), names << np.uint64(6))
        short = ((low >> np.uint64(8)) % np.uint64(EMPTY)).astype(np.uint16)
        short[low == np.uint64(2**64 - 1)] = EMPTY
        out[group] = short.reshape(-1, BINS)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the bins that either of two fingerprints fills, the share that are equal; 1 if neither has any."""
    filled = (a != EMPTY) | (b != EMPTY)
    same = ((a == b) & filled).sum(axis=-1)
    n = filled.sum(axis=-1)
    return np.where(n == 0, 1.0, same / np.maximum(n, 1))


def told(b: np.ndarray) -> list[str]:
    return [x.astype(">u2").tobytes().hex() for x in b]


def fingerprints(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """docs with a column of fingerprints of the whole texts, a string of hexadecimal digits; equal texts have equal ones, null counts as empty."""
    names = [c for c in docs.columns if c.lower() != column.lower()]
    source = docs.select(*[docs[c] for c in names])
    place = source.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = told(bins([(x.as_py() or "").encode() for x in batch.column(place)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names=[*names, column])

    return source.mapInArrow(run, source.withColumn(column, F.lit("")).schema)


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, is_copy, doc_id, text): docs in ranges of ascending doc_id, and at the end of each range a copy of the row that comes next.

    Bounds of the ranges are quantiles of doc_id; the first row of each range is the only one that
    is copied, into the range before (into the last one for the very first row). Null ids come
    first; rows of equal id follow the order of their texts.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or [])) if parts > 1 else []
    part = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    rows = rows.withColumn("part", F.greatest(part, F.lit(0)).cast("int"))
    first = rows.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("r"))
    there = sorted(r["part"] for r in rows.select("part").distinct().collect())
    before = F.create_map(*[F.lit(x) for i, p in enumerate(there) for x in (p, there[i - 1])]) if there else None
    body = rows.select("part", F.lit(False).alias("is_copy"), "doc_id", "text")
    if before is None:
        return body
    return body.union(first.select(before[F.col("part")].alias("part"), F.lit(True).alias("is_copy"), "r.doc_id", "r.text"))


#: Bytes of text of a task, about.
PART_BYTES = 32 << 20
COMPARED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(docs: DataFrame) -> DataFrame:
    """Per document, its fingerprint beside those of its edited text and of the next document.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document in ascending doc_id; after the last comes the first. A table of one
    row follows itself; repeated rows follow each other.
    """
    import hashlib

    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    rows = in_order(docs, 2 * n).repartition(n, "part").sortWithinPartitions("part", "is_copy", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose next one has not come yet
        for batch in batches:
            ids, texts, follow = [], [], []
            for part, is_copy, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting and waiting[0] == part:
                    ids.append(waiting[1])
                    texts.append(waiting[2])
                    follow.append(text)
                waiting = None if is_copy else (part, doc_id, text)
            if not ids:
                continue
            edited = [(t[: len(t) - len(t) // 2] + f[: len(t) // 2]).encode() for t, f in zip(texts, follow, strict=True)]
            # the next document of one row is mostly the document of the row after
            plain = [t.encode() for t in texts]
            after = [f.encode() for f in follow]
            mine = bins([*plain, after[-1]])
            following = np.concatenate([mine[1:]])
            odd = [i for i in range(len(ids) - 1) if follow[i] is not texts[i + 1] and follow[i] != texts[i + 1]]
            if odd:
                following[odd] = bins([after[i] for i in odd])
            mine, other = mine[:-1], bins(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                    pa.array(told(mine)),
                    pa.array(told(other)),
                    pa.array(likeness(mine, other)),
                    pa.array(likeness(mine, following)),
                ],
                names=[x.split()[0] for x in COMPARED.split(", ")],
            )

    return rows.mapInArrow(run, COMPARED)
