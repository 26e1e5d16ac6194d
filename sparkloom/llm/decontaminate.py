"""Benchmark decontamination by latent semantic retrieval.

Passages of all documents are TF-IDF vectors over hashed words; a randomised SVD, whose sums are
made in one distributed pass, gives a space in which passages near a benchmark item are found by
cosine. Candidates are then checked word by word: the longest common subsequence with the item and
the presence of some of its rarest words, which stand for its answer, so that paraphrases with
changed words are caught. Items too short for a passage's vector, and those of common words, are
found by their rarest words instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, saved, word_hashes, word_spans

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
#: Hashed features, dimensions of the latent space and further ones of the random sketch.
FEATURES, RANK, OVERSAMPLE = 4096, 64, 8
#: Words of a block; a passage is two blocks in a row.
BLOCK = 16
#: A feature with a larger share of all words says nothing.
COMMON = 1 / 300
#: Least cosine of a candidate, share of the shorter side's telling words that both must have, of an item's words in the common subsequence, and of its rarest words.
COSINE, SHARED, SUBSEQUENCE, ANSWER, ANSWER_WORDS = 0.35, 0.4, 0.65, 0.4, 5
#: An item with a smaller share of telling words is found by the words themselves.
LEAST_TELLING = 0.25
#: An item of fewer words than that must be there whole: a paraphrase of it can't be told from other text.
LEAST_WORDS = 8
#: Items are held in every task, so no more at a time.
MOST_ITEMS = 20_000


def _batches(texts: list[str | None], size: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of some texts together, and where each text's begin (with the end at last)."""
    waiting: list[bytes] = []
    n = 0
    for i, t in enumerate(texts):
        waiting.append((t or "").encode().lower())
        n += len(waiting[-1])
        if n >= size or i == len(texts) - 1:
            data = np.frombuffer(b"\n".join(waiting), np.uint8)
            starts, ends = word_spans(data, IS_WORD)
            yield word_hashes(data, starts, ends), np.searchsorted(starts, np.cumsum([0, *(len(w) + 1 for w in waiting)]))
            waiting, n = [], 0


def features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(52)).astype(np.int64)


def blocks(words: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each word, and the first block of each text (with the end at last)."""
    sizes = np.diff(cuts)
    first = np.concatenate([[0], np.cumsum(-(-sizes // BLOCK))])
    place = np.arange(words) - np.repeat(cuts[:-1], sizes)
    return np.repeat(first[:-1], sizes) + place // BLOCK, first


def block_sums(table: np.ndarray, f: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The sum of the table's rows over the features of each block; begin: where each block's begin. The table's last row is zero."""
    sizes = np.diff(begin, append=len(f))
    of = np.repeat(np.arange(len(begin)), sizes)
    at = np.full((BLOCK, len(begin)), FEATURES)
    at[np.arange(len(f)) - begin[of], of] = f
    total = table[at[0]]
    for row in at[1:]:
        total += table[row]
    return total


def inverse_frequency(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The weight of each feature from its count in all documents, where common features weigh nothing; and how rare each is, common ones too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for words, _ in _batches(batch.column(0).to_pylist()):
                total += np.bincount(features(words), minlength=FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(total)], names=["feature", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(FEATURES)
    for r in rows:
        count[r["feature"]] = r["n"]
    total = max(count.sum(), 1.0)
    rarity = np.log(total / (count + 1.0)).clip(0).astype(np.float32)
    return np.where(count > COMMON * total, np.float32(0), rarity), rarity


def latent_space(docs: DataFrame, weight: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weighted word vectors: the right singular vectors of A, all blocks by weighted features, by a randomised SVD.

    Each task adds up its part of Z = A'A R, R being random; rows (feature, sums) are added by a
    grouped sum, and as many numbers as features by dimensions reach the driver. As A'A is positive,
    Z (R'Z)^-1 Z' comes near it (Nystroem's way), and the singular vectors of its root Z L^-T, LL'
    being R'Z, are A's, with A's singular values squared; the RANK largest are taken.
    """
    width = RANK + OVERSAMPLE
    random = np.random.default_rng(seed).standard_normal((FEATURES, width))
    sketch = np.vstack([random * weight[:, None], np.zeros((1, width))]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, width))
        for batch in batches:
            for words, cuts in _batches(batch.column(0).to_pylist()):
                f = features(words)
                block, _ = blocks(len(words), cuts)
                telling = weight[f] > 0
                f, block = f[telling], block[telling]
                if not len(f):
                    continue
                new = np.flatnonzero(np.diff(block, prepend=-1))
                y = np.ascontiguousarray(block_sums(sketch, f, new).T)
                row = np.cumsum(np.diff(block, prepend=block[0]) != 0)
                for k in range(width):
                    total[:, k] += np.bincount(f, weights=y[k][row], minlength=FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), *(pa.array(total[:, k]) for k in range(width))], names=["feature", *(f"z{k}" for k in range(width))])

    names = [f"z{k}" for k in range(width)]
    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "feature bigint, " + ", ".join(f"{n} double" for n in names))
    z = np.zeros((FEATURES, width))
    for r in rows.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names]).collect():
        z[r["feature"]] = r[1:]
    z *= weight[:, None]
    shift = 1e-6 * max(float(np.linalg.norm(z)), 1e-9)  # keeps the factor away from singular
    z += shift * random
    inner = random.T @ z
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    root = z @ (vectors / np.sqrt(np.maximum(values, 1e-6 * max(float(values[-1]), 1e-30))))
    u, _, _ = np.linalg.svd(root, full_matrices=False)
    return np.vstack([u[:, :RANK] * weight[:, None], np.zeros((1, RANK))]).astype(np.float32)


def common_subsequence(item: dict[int, int], words: list[int]) -> int:
    """The length of the longest common subsequence of words with an item, given as a mask of places for each of its words."""
    v = 0
    for w in words:  # bit-parallel: a row of the table in one integer
        x = v | item.get(w, 0)
        v = x & ~(x - ((v << 1) | 1))
    return v.bit_count()


class Items:
    """Benchmark items with their vectors; an item longer than a passage has several.

    A short item or one of few telling words has no vector that finds it; its rarest words are looked up.
    """

    def __init__(self, items: list[tuple[int, str]], weight: np.ndarray, space: np.ndarray, rarity: np.ndarray):
        kept = [(i, t) for i, t in items if t and t.strip()]
        self.ids = [i for i, _ in kept]
        self.words: list[np.ndarray] = []
        for words, cuts in _batches([t for _, t in kept]):
            self.words += [words[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.masks, self.rare, vectors, self.of = [], [], [], []
        self.telling = np.zeros((len(self.words), FEATURES + 1), bool)
        for n, w in enumerate(self.words):
            mask: dict[int, int] = {}
            for place, x in enumerate(w.tolist()):
                mask[x] = mask.get(x, 0) | 1 << place
            self.masks.append(mask)
            f = features(w)
            order = np.argsort(-rarity[f], kind="stable")
            self.rare.append(set(w[order].tolist()[:ANSWER_WORDS]))
            self.telling[n, f[weight[f] > 0]] = True
            for a in range(0, max(1, len(w) - BLOCK), BLOCK // 2) if len(w) > 2 * BLOCK else [0]:
                vectors.append(space[f[a : a + 2 * BLOCK]].sum(axis=0))
                self.of.append(n)
        self.n_telling = self.telling.sum(axis=1)
        v = np.array(vectors, np.float32).reshape(-1, RANK)
        self.vectors = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        self.of = np.array(self.of, np.int64)
        few = [n for n, w in enumerate(self.words) if len(w) < BLOCK or np.count_nonzero(weight[features(w)]) < LEAST_TELLING * len(w)]
        pairs = sorted((x, n) for n in few for x in self.rare[n])
        #: The rarest words of such items, in order, and the item of each.
        self.rare_words = np.array([x for x, _ in pairs], np.uint64)
        self.rare_of = np.array([n for _, n in pairs], np.int64)


def by_words(words: np.ndarray, cuts: np.ndarray, text: np.ndarray, begin: np.ndarray, ends: np.ndarray, items: Items) -> list[tuple[int, int]]:
    """(passage, item) for short items and those of few telling words: texts that hold enough of an item's rarest words, and there the passages of which enough words are the item's."""
    lo, hi = (np.searchsorted(items.rare_words, words, side) for side in ("left", "right"))
    hit = np.flatnonzero(hi > lo)
    n = (hi - lo)[hit]
    pair = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    in_text = np.repeat(np.searchsorted(cuts, hit, side="right") - 1, n)
    # every row of rare_words is a word of one item, so distinct rows are distinct words
    key = np.unique(in_text * max(1, len(items.rare_words)) + pair)
    found, count = np.unique(np.stack([key // max(1, len(items.rare_words)), items.rare_of[key % max(1, len(items.rare_words))]]), axis=1, return_counts=True)
    out = []
    for t, k, c in zip(*found.tolist(), count.tolist(), strict=True):
        if c < ANSWER * len(items.rare[k]):
            continue
        a, b = np.searchsorted(text, [t, t + 1])
        own = np.concatenate([[0], np.cumsum(np.isin(words[cuts[t] : cuts[t + 1]], items.words[k]))])
        held = own[ends[a:b] - cuts[t]] - own[begin[a:b] - cuts[t]]
        enough = held >= SHARED * np.minimum(ends[a:b] - begin[a:b], len(items.words[k]))
        out += [(w, k) for w in (a + np.flatnonzero(enough)).tolist()]
    return out


FOUND = "place bigint, item_id bigint, share double, first_word bigint"


def find(words: np.ndarray, cuts: np.ndarray, weight: np.ndarray, space: np.ndarray, items: Items) -> list[tuple[int, int, float, int]]:
    """(text, item, share of the common subsequence, first word) of the leaks in some texts."""
    f = features(words)
    block, first = blocks(len(words), cuts)
    if not len(f) or not len(items.vectors):
        return []
    begin = np.flatnonzero(np.diff(block, prepend=-1))
    part = block_sums(space, f, begin)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(first))
    pair = part.copy()
    follows = np.flatnonzero(text[1:] == text[:-1])
    pair[follows] += part[follows + 1]
    norm = np.maximum(np.linalg.norm(pair, axis=1, keepdims=True), 1e-9)
    close = (pair / norm) @ items.vectors.T
    window, vector = np.nonzero(close >= COSINE)
    item = items.of[vector]  # both ascend, so an item's vectors lie together
    other = np.diff(window, prepend=-1) != 0
    other |= np.diff(item, prepend=-1) != 0
    window, item = window[other], item[other]
    # telling words that passage and item share, for all candidates at once
    ends = np.append(begin[1:], len(f))
    last = np.where(np.append(text[1:], -1) == text, np.arange(len(text)) + 1, np.arange(len(text)))
    at = begin[:, None] + np.arange(2 * BLOCK)
    told = np.where(at < ends[last][:, None], f[np.minimum(at, len(f) - 1)], FEATURES)
    n_telling = (np.append(weight > 0, False)[told]).sum(axis=1)
    shared = items.telling.ravel()[told[window] + (item * (FEATURES + 1))[:, None]].sum(axis=1)
    enough = shared >= SHARED * np.minimum(n_telling[window], items.n_telling[item])
    pairs = list(zip(window[enough].tolist(), item[enough].tolist(), strict=True))
    if len(items.rare_words):
        pairs = sorted({*pairs, *by_words(words, cuts, text, begin, ends[last], items)})
    out: dict[tuple[int, int], tuple[float, int]] = {}
    for w, n in pairs:
        a, b = begin[w], ends[last[w]]
        # the item may begin before the passage and end after it
        size = len(items.words[n])
        lo, hi = max(cuts[text[w]], a - size), min(cuts[text[w] + 1], b + size)
        region = words[lo:hi].tolist()
        hit = [k for k, x in enumerate(region) if x in items.rare[n]]
        if len({region[k] for k in hit}) < ANSWER * len(items.rare[n]):
            continue
        best, where = 0, 0
        for s in range(0, max(1, len(region) - size), max(1, size // 4)):
            length = common_subsequence(items.masks[n], region[s : s + size + size // 4])
            if length > best:
                best, where = length, s
        share = best / size
        key = (int(text[w]), n)
        if share >= (SUBSEQUENCE if size >= LEAST_WORDS else 1) and share > out.get(key, (0.0, 0))[0]:
            out[key] = (share, int(lo + where - cuts[text[w]]))
    return [(t, items.ids[n], share, at) for (t, n), (share, at) in out.items()]


def leaks(docs: DataFrame, benchmark: DataFrame, column: str = "leaks") -> DataFrame:
    """docs with the benchmark items found in each whole text: an array of (item_id, share, first_word), empty where none is.

    Null and empty texts and items leak nothing; repeated rows each have their leaks. Items
    (item_id, text) are held in every task, so more than MOST_ITEMS take several passes over docs.
    """
    rows = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).toLocalIterator()
    weight, rarity = inverse_frequency(docs)
    space = latent_space(docs, weight)
    found, part = None, [(r["item_id"], r["text"]) for r in islice(rows, MOST_ITEMS)]
    while found is None or part:
        source = docs if found is None else saved(found, "leaks")
        found = _leaks(source, Items(part, weight, space, rarity), weight, space, column, found is not None)
        part = [(r["item_id"], r["text"]) for r in islice(rows, MOST_ITEMS)]
    return found


def _leaks(docs: DataFrame, items: Items, weight: np.ndarray, space: np.ndarray, column: str, again: bool) -> DataFrame:
    """docs with the leaks of some items; again: after those that the column has already."""
    names = [c for c in docs.columns if c.lower() != column.lower()]
    nothing = F.lit(None).cast("array<struct<item_id:bigint,share:double,first_word:bigint>>")
    source = docs.select(*[docs[c] for c in names], *([docs[column]] if again else []))
    place = names.index("text")
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64()), ("first_word", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list[dict]] = []
            for words, cuts in _batches(batch.column(place).to_pylist()):
                base = len(made)
                made += [[] for _ in range(len(cuts) - 1)]
                for t, item, share, at in find(words, cuts, weight, space, items):
                    made[base + t].append({"item_id": item, "share": share, "first_word": at})
            if again:
                made = [a + b for a, b in zip(batch.column(len(names)).to_pylist(), made, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(made, kind)], names=[*names, column])

    return source.mapInArrow(run, source.withColumn(column, nothing).schema)


def kept(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a benchmark item, with all their columns. Null and empty texts stay; repeated rows stay or go together."""
    column = free_name(docs, "leaks")
    found = leaks(docs, benchmark, column)
    return found.where(F.size(column) == 0).select(*[found[c] for c in docs.columns])


def reported(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_items, item_ids (sorted, comma-joined) and the largest share."""
    found = leaks(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark)
    return found.select(
        "doc_id",
        F.size("leaks").cast("bigint").alias("n_items"),
        F.array_join(F.transform(F.array_sort(F.transform("leaks", lambda x: x["item_id"])), lambda i: i.cast("string")), ",").alias("item_ids"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["share"])), F.lit(0.0)).alias("best_share"),
    )
