"""Toxicity by compression distance: which of two zstandard dictionaries makes a text's windows shorter.

Before compression a word becomes the codes, 8 bytes each, of itself and of its first letters, so
that a short word counts as much as a long one and words of one stem have something in common.
Each dictionary is trained on the texts of its class: both have the codes that texts commonly
have, and each the codes that its own class's texts have and the other's mostly don't. A text's
windows are compressed with either, and a logistic calibration turns the differences of lengths
into a score.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dropped, free_name, saved, word_hashes, word_spans

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
#: Bytes of a word's beginnings that have codes of their own, where the word is longer.
BEGINNINGS = (4, 5, 6, 7)
#: Codes of a window: a dozen words.
WINDOW = 12 * (1 + len(BEGINNINGS))
#: Bytes from which on a window counts as better explained by one dictionary: less than half a code.
GAIN = 3
#: Labelled texts of each class that a model is fitted on at most; the rest of the labels only sets the classes' weights.
SAMPLE = 5000
#: Codes of the common part and of a class's own part, share of a class's texts that must have such a code, and how much likelier (as a logarithm) they must have it than the other's.
COMMON, OWN, SUPPORT, ODDS = 4000, 256, 0.02, 2.0
#: Features of a text.
WIDTH = 9
#: zstandard doesn't index the last bytes of a dictionary, so they must not be a code's.
_TAIL = bytes(range(64, 96))


def codes(texts: list[str | None]) -> list[np.ndarray]:
    """The codes of each text's words and their beginnings, in order."""
    out: list[np.ndarray] = []
    waiting: list[bytes] = []
    size = 0

    def flush() -> None:
        data = np.frombuffer(b"\n".join(waiting), np.uint8)
        starts, ends = word_spans(data, IS_WORD)
        of_word = [word_hashes(data, starts, ends)]
        for n in BEGINNINGS:
            of_word.append(np.where(ends - starts > n, word_hashes(data, starts, np.minimum(ends, starts + n)) ^ np.uint64(n), np.uint64(0)))
        all_codes = np.stack(of_word, axis=1)
        cuts = np.searchsorted(starts, np.cumsum([0, *(len(w) + 1 for w in waiting)]))
        out.extend(x[x != 0] for x in (all_codes[i:j].ravel() for i, j in zip(cuts[:-1], cuts[1:], strict=True)))

    for t in texts:
        waiting.append((t or "").encode().lower())
        size += len(waiting[-1])
        if size >= 1 << 19:
            flush()
            waiting, size = [], 0
    if waiting:
        flush()
    return out


@functools.lru_cache(maxsize=4)
def _compressor(content: bytes):
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=5, hash_log=16, chain_log=15, window_log=18, search_log=2, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=dictionary).compress


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def features(self, words: np.ndarray) -> list[float]:
        """Bytes that the toxic dictionary gains in the windows that it makes shorter, their number, both also as shares, and the share of those that the ordinary one makes shorter."""
        a, b, raw, step = _compressor(self.ordinary), _compressor(self.toxic), words.tobytes(), 8 * WINDOW
        gain = np.array([len(a(w := raw[i : i + step])) - len(b(w)) for i in range(0, len(raw), step)] or [0])
        more, less, n = gain[gain >= GAIN], np.count_nonzero(gain <= -GAIN), len(gain)
        return [1.0, np.log1p(more.sum()), np.log1p(len(more)), float(len(more) > 0), np.log1p(len(words)) / 10, more.sum() / n / 10, len(more) / n, less / n, min(1.0, more.max(initial=0) / 20)]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(w) for w in codes(texts)]).reshape(-1, WIDTH)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - 1e-2 * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    return b


def fit(docs: DataFrame, labels: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> Model:
    """A model from the labelled texts (labels: doc_id, toxic) whose doc_id the condition training admits.

    Equal texts count once, as toxic if one of them is. Of each class, the sample texts with the
    smallest hashes are taken (all, if fewer): a bounded sample, whose ids are joined to the texts.
    Half of them choose the dictionaries' codes, the other half calibrates, in turn, so that no
    text is judged with codes that it chose itself. Counts and features are made in tasks; only
    the counts of codes with enough support and the features reach the driver. Rows without text,
    id or label are left out. Without any toxic or any ordinary text every score is that of the
    only class, 0 without both.
    """
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    if training is not None:
        labels = labels.where(training)
    keyed = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("key"))
    texts = keyed.join(labels, "doc_id").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = texts.where("toxic = 1").orderBy("key").limit(sample).union(texts.where("toxic = 0").orderBy("key").limit(sample))
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), ["doc_id", "key"])
    rows = saved(found.dropDuplicates(["doc_id", "key"]).select("text", "toxic", F.pmod(F.xxhash64("key"), F.lit(2)).cast("int").alias("part")), "sample")
    size = np.zeros((2, 2))  # texts by class and part
    for r in rows.groupBy("toxic", "part").agg(F.count(F.lit(1)).alias("n")).collect():
        size[r["toxic"], r["part"]] = r["n"]
    if not size.sum(axis=1).all():
        dropped(rows)
        return Model(_TAIL, _TAIL, (30.0 if size[1].any() else -30.0, *[0.0] * (WIDTH - 1)))
    found, count = _supported(rows, size)
    models = [Model(*_dictionaries(found, count[:, :, p].sum(axis=2), size[:, p].sum(axis=1)), ()) for p in ([1], [0], [0, 1])]
    x = np.array([r["x"] for r in _features(rows, models).collect()])
    dropped(rows)
    y, x = x[:, 0], x[:, 1:]
    weight = np.where(y == 1, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    return Model(models[2].ordinary, models[2].toxic, tuple(_logistic(x, y, weight)))


def _supported(rows: DataFrame, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes that enough of a class's texts (text, toxic, part) have, in one part or both, and the number of such texts by class and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                distinct = [np.unique(w) for w in codes(part.column(0).to_pylist())]
                cell = 2 * part.column(1).to_numpy() + part.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(distinct).view(np.int64)), pa.array(np.repeat(cell, [len(x) for x in distinct]), pa.int32())], names=["code", "cell"])

    of_cell = rows.mapInArrow(run, "code bigint, cell int").groupBy("code").agg(*[F.count_if(F.col("cell") == k).alias(f"c{k}") for k in range(4)])
    least = np.maximum(3, SUPPORT * size)
    enough = " OR ".join(f"c{2 * c + p} >= {least[c, p]}" for c in (0, 1) for p in (0, 1)) + "".join(f" OR c{2 * c} + c{2 * c + 1} >= {max(3, SUPPORT * size[c].sum())}" for c in (0, 1))
    table = of_cell.where(enough).orderBy("code").toArrow()
    return table.column(0).to_numpy().view(np.uint64), np.stack([table.column(f"c{k}").to_numpy() for k in range(4)], axis=1).reshape(-1, 2, 2)


def _features(rows: DataFrame, models: list[Model]) -> DataFrame:
    """Of each text its class and features, by the model of the part that it is not in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                made = [[float(y), *models[p].features(w)] for w, y, p in zip(codes(some.column(0).to_pylist()), some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64()))], names=["x"])

    return rows.mapInArrow(run, "x array<double>")


def _dictionaries(found: np.ndarray, count: np.ndarray, size: np.ndarray) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary from codes, the number of texts of each class that have them, and of all."""
    own = []
    for c in (0, 1):
        mine, other = count[:, c], count[:, 1 - c]
        odds = np.log((mine + 0.5) / (size[c] + 1)) - np.log((other + 0.5) / (size[1 - c] + 1))
        marks = np.flatnonzero((mine >= max(3, SUPPORT * size[c])) & (odds > ODDS))
        own.append(found[marks[np.argsort(odds[marks] * mine[marks], kind="stable")][-OWN:]])
    common = found[np.argsort(count[:, 0], kind="stable")[-COMMON:]]
    common = common[~np.isin(common, np.concatenate(own))].tobytes()
    return tuple(common + x.tobytes() + _TAIL for x in own)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the score of each whole text in a column (replaced if there): 0 to 1, of an empty or null text too. Repeated rows stay."""
    names = [c for c in docs.columns if c.lower() != column.lower()]
    source = docs.select(*[docs[c] for c in names])
    place = source.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):  # codes take several times a text's room
                part = batch.slice(i, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(part.column(place).to_pylist()))], names=[*names, column])

    return source.mapInArrow(run, source.withColumn(column, F.lit(0.0)).schema)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text is divisible by 5."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("bigint").cast("string").cast("binary")) % 5 == 0


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held_out, score and predicted, from a model of the labelled rows that are not held out."""
    model = fit(docs, labels, ~held_out())
    scored = score(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), model)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """docs without those that score threshold or more; the model is fitted on all labelled rows. Empty and null texts have the score of a text without words; repeated rows stay or go together, and all columns stay as they are."""
    column = free_name(docs, "score")
    scored = score(docs, fit(docs, labels), column=column)
    return scored.where(F.col(column) < threshold).select(*[scored[c] for c in docs.columns])
