"""License scans: phrases by place, and notices by an exact set-similarity join with templates."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import word_hashes, word_spans

#: Bytes of words once A-Z are lower-cased: digits, a-z and all beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

#: Phrases of the base labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices of the method, by label. The words that publishers of these licenses give for notices.
TEMPLATES = {
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "apache": ["Licensed under the Apache License, Version 2.0."],
    "mit": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
#: Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.9


def words(text: str) -> list[str]:
    return [w.decode() for w in re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.encode().lower())]


class Templates:
    """Templates as sets of word numbers in ascending order of global frequency.

    A block that holds at least t of a template's n words holds one of its n - t + 1 rarest: its
    prefix. So only blocks with such a word are compared, and only from the first common word on.
    """

    def __init__(self, templates: dict[str, list[str]], containment: float, frequency: dict[str, int] | None = None):
        texts_ = [(label, words(t)) for label, texts in templates.items() for t in texts]
        sets = [(label, set(w)) for label, w in texts_]
        frequency = frequency or {}
        self.vocabulary = sorted({w for _, s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.labels = [label for label, _ in sets]
        self.sets = [np.array(sorted(number[w] for w in s)) for _, s in sets]
        self.need = [max(1, math.ceil(containment * len(s) - 1e-9)) for s in self.sets]
        #: Of each template the word numbers as they stand in it.
        self.rows = [[number[w] for w in ws] for _, ws in texts_]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, s in enumerate(self.sets):
            for position, w in enumerate(s[: len(s) - self.need[t] + 1]):
                self.prefix.setdefault(int(w), []).append((t, position))
        joined = np.frombuffer(" ".join(self.vocabulary).encode(), np.uint8)
        hashes = word_hashes(joined, *word_spans(joined, IS_WORD))
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.longest = max((len(w) for _, w in texts_), default=1)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that templates have, and their numbers."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        return hit, self.order[at[hit]]

    def matches(self, block: np.ndarray, size: int) -> list[tuple[int, float]]:
        """Templates that a block (sorted distinct numbers of template words; size: how many words it has, of templates or not) holds, and the share held."""
        tried, out = set(), []
        for place, w in enumerate(block):
            for t, position in self.prefix.get(int(w), ()):
                # length: the block must have enough words; position: so must what is left on either side
                if t in tried or size < self.need[t] or min(len(block) - place, len(self.sets[t]) - position) < self.need[t]:
                    continue
                tried.add(t)
                held = len(np.intersect1d(block, self.sets[t], assume_unique=True))
                if held >= self.need[t]:
                    out.append((t, held / len(self.sets[t])))
        return out

    def in_order(self, k: int, block: list[int]) -> tuple[int, int, int]:
        """Distinct words in the longest common subsequence of template k and a block (word numbers as they stand), and where its first and last words are."""
        table = [[(0, 0)] * (len(self.rows[k]) + 1)]  # length, and the latest place of the first word
        for i, w in enumerate(block):
            above, row = table[-1], [(0, 0)]
            for j, x in enumerate(self.rows[k]):
                best = max(above[j + 1], row[j])
                if x == w:
                    n, first = above[j]
                    best = max(best, (n + 1, first if n else i))
                row.append(best)
            table.append(row)
        j = len(self.rows[k])
        i = end = next(i for i, row in enumerate(table) if row[j] == table[-1][j])
        held = set()
        while table[i][j][0]:
            if table[i - 1][j] == table[i][j]:
                i -= 1
            elif table[i][j - 1] == table[i][j]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                held.add(self.rows[k][j])
        return len(held), table[end][-1][1], end - 1


def blocks(key: np.ndarray, half: np.ndarray, hit: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Key and first half of each block, and places and numbers of its words: two halves in a row of one key (a line); each word is in the block that its half begins and in the one before."""
    rows = np.stack([np.tile(key, 2), np.concatenate([half, half - 1]), np.tile(hit, 2), np.tile(number, 2)])
    rows = rows[:, rows[1] >= 0]
    rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    cuts = np.flatnonzero(np.any(np.diff(rows[:2], axis=1, prepend=-1) != 0, axis=0))
    for lo, hi in zip(cuts, [*cuts[1:], rows.shape[1]], strict=True):
        yield int(rows[0, lo]), int(rows[1, lo]), rows[2, lo:hi], rows[3, lo:hi]


def word_frequency(docs: DataFrame, templates: dict[str, list[str]], text: str = "text") -> dict[str, int]:
    """How often each word of the templates stands in all of docs; as many rows as the templates have words reach the driver."""
    t = Templates(templates, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(t.vocabulary), np.int64)
        for batch in batches:
            for data in _buffers(batch.column(0)):
                _, n = t.numbers(word_hashes(data, *word_spans(data, IS_WORD)))
                total += np.bincount(n, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(t.vocabulary), pa.array(total)], names=["word", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in rows.collect()}


def _buffers(column: pa.Array, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """Lower-cased bytes of texts, some together, with a blank between them."""
    waiting, n = [], 0
    for x in column:
        b = (x.as_py() or "").encode().lower()
        waiting.append(b)
        n += len(b)
        if n >= size:
            yield np.frombuffer(b" ".join(waiting), np.uint8)
            waiting, n = [], 0
    if waiting:
        yield np.frombuffer(b" ".join(waiting), np.uint8)


SCAN = [
    ("n_words", "bigint"),
    ("places", "array<struct<phrase:string,word:bigint>>"),
    ("notices", "array<struct<label:string,template:int,first_word:bigint,last_word:bigint,share:double>>"),
]


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, containment: float = CONTAINMENT, phrases: dict[str, str] | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row of docs, the columns keep and what its whole text holds of phrases and template notices.

    n_words counts words; places has each place where the words of a phrase stand one after the
    other; notices has every text block whose words contain the given share of a template's. Blocks
    are lines, whose words may stand in any order, and the text's words whatever lines they are in,
    of which so many must stand in the template's order: a notice may be wrapped, but words that
    several lines happen to have are none. A line or text of more words than twice the longest
    template is cut into blocks of that length that overlap by half, so that any run of words as
    long as a template lies in one block. A null or empty text has no words.
    """
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    keep = ["doc_id"] if keep is None else keep
    t = Templates(templates, containment, word_frequency(docs, templates, text))
    gap = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    patterns = [(p, re.compile(rb"(?<![0-9a-z\x80-\xff])" + gap.join(re.escape(w.encode()) for w in p.split()) + rb"(?![0-9a-z\x80-\xff])")) for p in phrases]
    source = docs.select(*[docs[c] for c in keep], docs[text].cast("string").alias("__text"))
    schema = docs.select(*[docs[c] for c in keep], *[F.lit(None).cast(kind).alias(name) for name, kind in SCAN]).schema
    kinds = pa.schema([("n_words", pa.int64()), ("places", pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))), ("notices", pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())])))])

    def one(raw: str) -> tuple:
        data = raw.encode().lower()
        bytes_ = np.frombuffer(data, np.uint8)
        starts, ends = word_spans(bytes_, IS_WORD)
        places = [{"phrase": p, "word": int(np.searchsorted(starts, m.start()))} for p, pattern in patterns for m in pattern.finditer(data)]
        notices = []
        hit, number = t.numbers(word_hashes(bytes_, starts, ends)) if len(starts) else (starts, starts)
        if len(hit) and np.isin(number, list(t.prefix)).any():
            line = np.searchsorted(np.flatnonzero(bytes_ == 10), starts)
            at_line = line[hit]
            half = (hit - np.searchsorted(line, at_line)) // t.longest
            found: dict[tuple[int, int, int], float] = {}
            words_of_line = np.bincount(line)
            for key, begin, at, held in blocks(at_line, half, hit, number):
                for k, share in t.matches(np.unique(held), min(2 * t.longest, int(words_of_line[key]) - begin * t.longest)):
                    inside = at[np.isin(held, t.sets[k])]
                    found.setdefault((k, int(inside[0]), int(inside[-1])), share)
            if line[-1]:
                wrapped: dict[tuple[int, int, int], float] = {}
                for _, begin, at, held in blocks(np.zeros_like(hit), hit // t.longest, hit, number):
                    for k, _ in t.matches(np.unique(held), min(2 * t.longest, len(starts) - begin * t.longest)):
                        n, first, last = t.in_order(k, held.tolist())
                        if n >= t.need[k] and line[at[first]] != line[at[last]]:
                            wrapped[k, int(at[first]), int(at[last])] = n / len(t.sets[k])
                # blocks overlap: of notices in one place the one that holds most stays
                for (k, first, last), share in sorted(wrapped.items(), key=lambda x: -x[1]):
                    if not any(j == k and a <= last and first <= b and held >= share for (j, a, b), held in found.items()):
                        found[k, first, last] = share
            notices = [{"label": t.labels[k], "template": k, "first_word": a, "last_word": b, "share": share} for (k, a, b), share in found.items()]
        return len(starts), places, notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(x.as_py() or "") for x in batch.column(batch.num_columns - 1)]
            columns = [pa.array([m[i] for m in made], kinds.field(i).type) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *kinds.names])

    return source.mapInArrow(run, schema)


def labelled(docs: DataFrame) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels and score.

    The base is the places of PHRASES; labels has those of the notices found too. score is the
    largest share of a notice's words found, at least 0.5 where a base phrase stands, else 0.
    One row for each row of docs, repeated ids included; empty and null texts have no labels.
    """
    found = scan(docs.select(F.col("doc_id").cast("bigint"), "text"))
    label = F.create_map(*[F.lit(x) for kv in PHRASES.items() for x in kv])
    base = F.array_distinct(F.transform("places", lambda p: label[p["phrase"]]))
    notices = F.transform("notices", lambda n: n["label"])
    place = F.transform("places", lambda p: p["word"])
    best = F.coalesce(F.array_max(F.transform("notices", lambda n: n["share"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(place).alias("first_word"),
        F.array_max(place).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, notices))), ",").alias("labels"),
        F.greatest(best, F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
