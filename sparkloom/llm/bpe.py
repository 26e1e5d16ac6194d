"""Byte-pair encoding and decoding with a public vocabulary file, in batched numpy merge rounds."""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs are keyed as left * PAIR + right.
PAIR = 1 << 20
#: Distinct pieces of text from which on a task forgets their ids, and the longest whose ids it keeps.
CACHE, CACHED_LENGTH = 100_000, 64
#: Not white space for Unicode, but for str.split.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# Letters and numbers that the regex module knows and the vocabulary's own library, with an older Unicode, doesn't.
NEWER_LETTERS = (
    "558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d "
    "107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11df1-11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff "
    "18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 "
    "1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
NEWER_NUMBERS = "11de0-11de9 1246f-1246f 12475-1247f 12550-12686 16ff4-16ff6"
# Lower cases that the vocabulary's own library knows and Python's Unicode doesn't, and ranges with the distance of theirs.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_LOWER_RANGES = [(0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)]
_LOWER = NEWER_LOWER | {c: c + far for a, b, far in NEWER_LOWER_RANGES for c in range(a, b + 1)}
_HAS_LOWER = regex.compile("[" + "".join(map(chr, _LOWER)) + "]")


def _class(ranges: str) -> str:
    """A character class of hexadecimal ranges."""
    return "[" + "".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in (r.split("-") for r in ranges.split())) + "]"


def _plain(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    return [letters[b] for b in range(256)] if len(letters) == 256 else [x for _, x in sorted((letters | {b: chr(256 + i) for i, b in enumerate(hidden)}).items())]


class WordBpe:
    """A tokenizer of words with an end mark, read from a JSON file of vocabulary and merges.

    Text is put in NFC, lower-cased letter by letter, split by the file's pattern and encoded as
    bytes; special tokens found in the text have their own ids. Decoding joins tokens by blanks.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = pattern.replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern + "|\n")
        strange = _class(NEWER_LETTERS + " " + NEWER_NUMBERS)
        self.strange = regex.compile(strange)
        inner = strange[1:-1]
        own = pattern.replace(r"[\p{L}]", f"[\\p{{L}}--[{inner}]]").replace(r"[\p{N}]", f"[\\p{{N}}--[{inner}]]")
        own = own.replace(r"[^\p{White_Space}\p{L}\p{N}]", f"[[^\\p{{White_Space}}\\p{{L}}\\p{{N}}]||[{inner}]]")
        self.strange_pattern = regex.compile(own + "|\n", regex.V1)
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + mark] for c in letters], np.int64)
        merges = np.array([(vocab[a] * PAIR + vocab[b], vocab[a + b]) for a, b in model["merges"]], np.int64)
        order = np.argsort(merges[:, 0], kind="stable")
        self.keys, self.ranks, self.made = merges[order, 0], order.astype(np.int64), merges[order, 1]
        self.made_by_rank = merges[:, 1]
        self.cache: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many non-empty words in one flat array, and where each word's ids start.

        Each round finds the ranks of all neighbouring pairs by binary search over the sorted
        pair keys, takes the lowest rank of each word and merges its places from left to right.
        A made symbol takes part only in merges of higher rank, so the order of places is free.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_sym, done_word = [], []
        none = len(self.made_by_rank)
        rank = np.full(len(sym), none, np.int64)
        self._find(sym, word, rank, np.arange(len(sym) - 1))
        while len(sym):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(sym)))
            over = lowest == none
            if over.any():  # such words are ready and leave the array
                done_sym.append(sym[over])
                done_word.append(word[over])
                live = ~over
                sym, word, rank, lowest = sym[live], word[live], rank[live], lowest[live]
                if not len(sym):
                    break
            place = np.flatnonzero(rank == lowest)
            # of places in a row (a symbol with itself), every second one from the left
            run = np.flatnonzero(np.diff(place, prepend=-2) != 1)
            nth = np.arange(len(place)) - np.repeat(run, np.diff(run, append=len(place)))
            place = place[nth % 2 == 0]
            sym[place] = self.made_by_rank[rank[place]]
            keep = np.ones(len(sym), bool)
            keep[place + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            # only pairs with a made symbol have another rank now
            at = place - np.arange(len(place))
            self._find(sym, word, rank, np.concatenate([at, at[at > 0] - 1]))
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.searchsorted(word[order], np.arange(len(words)))

    def _find(self, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        """Puts into rank those of the pairs that begin at these places."""
        none = len(self.made_by_rank)
        rank[at] = none
        at = at[at < len(sym) - 1]
        at = at[word[at] == word[at + 1]]
        key = sym[at] * PAIR + sym[at + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[found] == key
        rank[at[hit]] = self.ranks[found[hit]]

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens; line feeds are kept as words."""
        pattern = self.pattern
        if not _plain(text):
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if _HAS_LOWER.search(text):
                text = text.translate(_LOWER)
            if self.strange.search(text):
                pattern = self.strange_pattern
        return pattern.findall(text.lower())

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Ids (as little-endian unsigned 32-bit integers) of pieces of text without line feeds."""
        words = self._words("\n".join(chunks))
        index = {w: i for i, w in enumerate(dict.fromkeys(words))}
        gap = index.get("\n", -1)
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        ids, starts = self.merge([w.encode() for w in index])
        sizes = np.diff(starts, append=len(ids))
        if gap >= 0:
            sizes[gap] = 0
        # the ids of all words in a row, cut at the line feeds
        size = sizes[at]
        ends = np.cumsum(size)
        flat = ids[np.repeat(starts[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        raw = flat.astype("<u4").tobytes()
        cuts = [0, *(4 * ends[at == gap]).tolist(), len(raw)] if len(at) else [0, 0]
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _whole(self, text: str) -> bytes:
        """The ids of a text that may hold special tokens or separators."""
        out, at = [], 0
        for m in [*self.special_pattern.finditer(text), None]:
            words = [w.encode() for w in self._words(text[at : m.start() if m else len(text)]) if w != "\n"]
            if words:
                out.append(self.merge(words)[0].astype("<u4").tobytes())
            if m:
                out.append(self.special[m[0]].to_bytes(4, "little"))
                at = m.end()
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of little-endian unsigned 32-bit integers."""
        # no token crosses white space, so a piece of text between it is encoded once
        chunked = [t.split() for t in texts]
        fresh: set[str] = set()
        for c in chunked:
            fresh.update(c)
        fresh -= self.cache.keys()
        if fresh:
            if len(self.cache) > CACHE:
                self.cache = {}
                fresh = {x for c in chunked for x in c}
            new = list(fresh)
            self.cache.update(zip(new, self._learn(new), strict=True))
        of = self.cache.__getitem__
        odd = [any(x in t for x in (*_SEPARATORS, *self.special)) for t in texts]
        out = [self._whole(t) if o else b"".join(map(of, c)) for t, c, o in zip(texts, chunked, odd, strict=True)]
        for c in filter(lambda c: len(c) > CACHED_LENGTH, fresh):
            del self.cache[c]
        return out

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Characters of text that are encoded together.
BATCH_CHARS = 500_000


def groups_of(texts: list[str]) -> Iterator[slice]:
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, path: str | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with a column of token ids (array of int; a null text counts as empty).

    Every whole text is encoded; nothing is cut. A column of that name that docs has already is replaced.
    """
    return _mapped(docs, path, text, ids, "array<int>", lambda t, texts: pa.array([np.frombuffer(b, "<i4") for b in t.encode(texts)], pa.list_(pa.int32())))


def decode(docs: DataFrame, path: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """docs with the text that a column of token ids stands for; null ids give an empty text."""
    return _mapped(docs, path, ids, text, "string", lambda t, many: pa.array([t.decode(np.asarray(x or [], "<u4").tobytes()) for x in many], pa.string()), "")


def _mapped(docs, path, source, target, kind, f, empty=""):
    path = path or default_vocabulary()
    names = [c for c in docs.columns if c.lower() != target.lower()]
    # a projection of fixed columns; names that only differ in case would clash
    schema = docs.select(*[docs[c] for c in names]).withColumn(target, F.lit(None).cast(kind)).schema

    def run(batches):
        pa.default_memory_pool().release_unused()  # a worker may hold what an earlier stage took
        t = tokenizer(path)
        for batch in batches:
            values = ["" if x is None and empty == "" and kind != "string" else x for x in batch.column(source).to_pylist()]
            for s in groups_of([x if isinstance(x, str) else "x" * len(x or ()) for x in values]):
                part = batch.slice(s.start, s.stop - s.start)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), f(t, values[s])], names=[*names, target])

    return docs.mapInArrow(run, schema)


DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document, the number of its tokens and the SHA-256 of its ids and of the text decoded from them.

    One row for each row of docs, repeated ids included; a null or empty text has no tokens.
    Ids and text are made and hashed in the same task, batch by batch, so no token is shuffled.
    """
    path = path or default_vocabulary()

    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            ids, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            for s in groups_of(texts):
                coded = t.encode(texts[s])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(s.start, s.stop - s.start),
                        pa.array([len(b) // 4 for b in coded], pa.int64()),
                        pa.array([hashlib.sha256(b).hexdigest() for b in coded]),
                        pa.array([hashlib.sha256(t.decode(b).encode()).hexdigest() for b in coded]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, DIGEST)
