"""Operators of the training-data subpackage against brute force, round trips and held-out accuracy."""

import base64
import collections
import hashlib
import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from sparkloom.llm import bpe, chat, decontaminate, fingerprints, jaccard, licenses, queries, secrets, shared, suffixes, toxicity, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, oracle, name):
    got = queries.queries()[name](spark, SF)
    want = oracle.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in got.select(names).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("share", [20, 50_000])
def test_components(spark, monkeypatch, share):
    monkeypatch.setattr(shared, "SHARE", share)
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in shared.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}


# --- token encoding


def test_bpe_equals_the_library(spark, docs, edge):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    rows = docs.union(edge)
    want = collections.Counter()
    for r in rows.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in bpe.digests(rows).collect()) == want


def test_bpe_special_tokens_and_odd_text():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    rng = random.Random(1)
    letters = "aAbB'sSΣσς́éİı ß\t\n\x0b\x1c\x85\xa0​中1²½😀<|endoftext|>%_-'re'LL՘"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(1500)] + ["<|endoftext|>x<|startoftext|>", "a" * 3000, "ab" * 2000]
    own = bpe.tokenizer(bpe.default_vocabulary())
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_bpe_every_code_point():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    t.no_truncation()
    t.no_padding()
    own = bpe.tokenizer(bpe.default_vocabulary())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 50_000):
        some = points[k : k + 50_000]
        some += [f"a{x}1" for x in some] if k < 200_000 else []
        for text, ids, want in zip(some, own.encode(some), t.encode_batch(some, add_special_tokens=False), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, hex(ord(text[len(text) // 2]))


def test_bpe_columns(edge, none):
    coded = bpe.decode(bpe.encode(edge.withColumn("IDS", F.lit(1))))
    assert coded.columns == [*edge.columns, "ids", "decoded"]
    assert {r["decoded"] for r in coded.where("text IS NULL OR text = ''").collect()} == {""}
    assert bpe.digests(none).count() == 0


# --- n-gram Jaccard join


def sets_of(rows, width):
    out = {}
    for doc_id, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
        out[doc_id] = frozenset([tuple(w[k : k + width]) for k in range(len(w) - width + 1)] or ([tuple(w)] if w else []))
    return out


def brute_components(sets, percent):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def edited_family(n, seed):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(400)}" for _ in range(60)]
    rows = []
    for i in range(n):
        w = list(words)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append(" ".join(w[: rng.randrange(50, 61)]))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_jaccard_equals_brute_force(spark, docs, width, percent):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(edited_family(60, 1) + edited_family(30, 2))]
    sets = sets_of(rows, width)
    got = jaccard.connected(spark.createDataFrame(rows, "doc_id bigint, text string"), width, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(sets, percent)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in got) and len(got) == len(rows)


def test_jaccard_splits_large_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_NODES", 8)
    rows = list(enumerate(edited_family(80, 5)))
    got = jaccard.connected(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(sets_of(rows, 4), 85)


def test_jaccard_edges(edge, none):
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in jaccard.connected(edge, 4, 85).collect())
    assert got == collections.Counter([(1, 1), (2, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 1), (8, 8), (9, 9), (None, 1)])
    assert jaccard.connected(none, 4, 85).count() == 0
    kept = jaccard.one_of_each(edge, 4, 85)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9]


def test_linked_sets_share_a_rare_shingle():
    rng = np.random.default_rng(2)
    ranks = rng.integers(0, 5, jaccard.COUNTERS, dtype=np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        keep = a[rng.random(len(a)) > 0.08 * rng.random()]
        b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 12)), dtype=np.uint64)]))
        for percent in (80, 85):
            if len(b) and jaccard.linked(a, b, percent):
                assert set(jaccard.rare(a, ranks, percent)) & set(jaccard.rare(b, ranks, percent))
                assert jaccard.pair_may_link(len(a), len(b), jaccard.bitmap(a), jaccard.bitmap(b), percent)


# --- benchmark decontamination


def test_decontamination(spark, docs, none, edge):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in (r["text"] or "")}
    changed = []
    for i, t in items[:20]:
        w = t.split()
        w[len(w) // 3] = "otherword"
        changed.append((50_000 + i, "some words before it stand here and there " + " ".join(w) + " and more after", "en", "s", 1))
    rows = docs.union(spark.createDataFrame(changed, docs.schema))
    got = {(r["doc_id"], int(i)) for r in decontaminate.reported(rows, bench).collect() for i in r["item_ids"].split(",") if i}
    assert want <= got
    assert {(50_000 + i, i) for i, _ in items[:20]} <= got
    assert len({d for d, _ in got} - {d for d, _ in want} - set(range(50_000, 60_000))) <= 1
    assert decontaminate.kept(edge, bench).columns == edge.columns and decontaminate.kept(edge, bench).count() == edge.count()
    assert decontaminate.reported(none, bench).count() == 0
    assert decontaminate.reported(edge, bench.where("false")).agg(F.sum("n_items")).first()[0] == 0


def test_decontaminate_passages_that_many_rows_hold(spark):
    """A passage in a third of short rows, and a corpus that is mostly copies of one: their words are common, and they are found."""
    rng = random.Random(11)
    prose = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passage = " ".join(f"item{i}" for i in range(38))
    bench = spark.createDataFrame([(1, passage), (2, prose(38)), (3, " "), (4, None)], "item_id bigint, text string")
    rows = [(i, f"{prose(20)} {passage} {prose(20)}" if i % 3 == 0 else prose(78)) for i in range(300)]
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.reported(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert got == {i: "1" if i % 3 == 0 else "" for i, _ in rows}
    rows = [(i, passage if i % 10 else prose(60)) for i in range(200)] + [(200, ""), (201, None), (202, " ".join(passage.split()[::-1]))]
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.reported(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert got == {i: "1" if i < 200 and i % 10 else "" for i, _ in rows}


def test_decontamination_recall(spark, docs):
    """Short items, and items of which a fifth or three tenths of the words are changed, dropped or moved, among prose; documents without one stay clean."""
    rng = random.Random(17)
    prose = [w for r in docs.collect() for w in re.findall(r"\w+", r["text"] or "")]
    some = lambda n: prose[(k := rng.randrange(len(prose) - n)) : k + n]
    kinds = {"short": 4, "nine": 9, "verbatim": 30, "changed 0.2": 30, "changed 0.3": 30, "dropped 0.2": 30, "moved 0.2": 30}
    items, rows = [], []
    for kind, size in kinds.items():
        for _ in range(60):
            w = some(size)
            items.append((len(items), " ".join(w)))
            share = float(kind.split()[1]) if " " in kind else 0
            for k in rng.sample(range(size), int(share * size)):
                if kind.startswith("changed"):
                    w[k] = rng.choice(prose)
                elif kind.startswith("dropped"):
                    w[k] = ""
                elif kind.startswith("moved") and rng.random() < 0.5:
                    w.insert(rng.randrange(size), w.pop(k))
            rows.append((items[-1][0], " ".join([*some(rng.randrange(20, 150)), *w, *some(rng.randrange(20, 150))])))
    rows += [(10_000 + i, " ".join(rng.sample(prose, 200))) for i in range(100)]
    found = decontaminate.reported(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    got = {r["doc_id"]: r["item_ids"].split(",") for r in found}
    for n, kind in enumerate(kinds):
        hits = [str(i) in got[i] for i in range(60 * n, 60 * n + 60)]
        assert sum(hits) >= 0.9 * len(hits), (kind, sum(hits))
    assert sum(got[10_000 + i] != [""] for i in range(100)) <= 2


def test_decontaminate_items_in_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    flat = lambda df: sorted((r["doc_id"], sorted(map(tuple, r["leaks"]))) for r in df.collect())
    want = flat(decontaminate.leaks(docs, bench))
    assert any(x for _, x in want)
    monkeypatch.setattr(decontaminate, "MOST_ITEMS", -(-bench.count() // 3))
    found = decontaminate.leaks(docs, bench)
    assert flat(found) == want and found.columns == [*docs.columns, "leaks"]


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 15))] for _ in range(2))
        mask = collections.defaultdict(int)
        for k, x in enumerate(a):
            mask[x] |= 1 << k
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(mask, b) == table[-1][-1]


# --- WARC


def test_warc(spark, none):
    rows = [(1, "http://b.example.com/x?q=1#f", "<p>a</p>"), (2, "http://a.example.com", "<p>a</p>"), (2, "http://a.example.com", "<p>a</p>"), (3, None, None), (4, "", ""), (5, "http://[bad", "é😀"), (None, "http://c.example.org/", "<p>a</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("URL_KEY", F.lit(1))
    got = sorted((tuple(r) for r in warc.write_and_read(pages).collect()), key=str)
    digest = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    first = {"<p>a</p>": 1, "": 3, "é😀": 5}
    want = sorted(((i, len((h or "").encode()), digest(h), "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, _, h in rows), key=str)
    assert got == want
    assert {r["record_type"] for r in warc.write_and_read(pages, least_bytes=100).collect()} == {"response"}
    assert warc.write_and_read(pages.where("false")).count() == 0


def test_warc_very_common_url(spark, monkeypatch):
    """One URL on most pages fills several blocks and shards, and is found whole."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    rows = [(i, "http://x.example.com/a" if i % 10 else f"http://{'mz'[i % 20 == 0]}.example.com/{i}", f"<p>{i % 50}</p>") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    folder = warc.folder_for(spark)
    captures = warc.write(pages, folder)
    directory = warc.index(captures, folder, block_lines=5)
    assert directory.groupBy("first_key").count().where("count > 1").count() >= 1
    for url, n in (("http://x.example.com/a", 270), ("http://m.example.com/10", 1), ("http://no.example.com/", 0)):
        assert warc.look_up(spark.createDataFrame([(url,), (url,), (None,)], "url string"), directory, folder).count() == n
    assert sorted(r["page_id"] for r in warc.write_and_read(pages).collect()) == list(range(300))


def test_warc_look_up(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = warc.folder_for(spark)
    captures = warc.write(pages, folder)
    directory = warc.index(captures, folder, block_lines=3)
    rows = pages.select("page_id", "url").collect()
    urls = spark.createDataFrame([(r["url"],) for r in rows[::3]] + [("http://nowhere.example.net/",), (None,)], "url string")
    found = warc.look_up(urls, directory, folder)
    keys = {warc.url_key(r["url"]) for r in rows[::3]}
    assert {r["page_id"] for r in found.collect()} == {r["page_id"] for r in rows if warc.url_key(r["url"]) in keys}
    payloads = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read(found, folder).where("record_type = 'response'").collect()}
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert payloads and all(html[k] == v for k, v in payloads.items())


# --- fingerprints


def test_fingerprints(spark, docs, edge, none):
    rows = docs.where("doc_id IS NOT NULL").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in fingerprints.compared(docs).collect()}
    for a, b in zip(rows, [*rows[1:], rows[0]], strict=True):
        n = len(a["text"]) // 2
        edited = a["text"][: len(a["text"]) - n] + b["text"][:n]
        r = got[a["doc_id"]]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(a["text"])
        assert 0 <= r["near_next"] <= 1
    # all fingerprints and likenesses, one text at a time
    alone = lambda t: fingerprints.bins([t.encode()])
    for a, b in zip(rows[:60], rows[1:61], strict=True):
        n = len(a["text"]) // 2
        mine, edited, following = alone(a["text"]), alone(a["text"][: len(a["text"]) - n] + b["text"][:n]), alone(b["text"])
        r = got[a["doc_id"]]
        assert [r["fingerprint"], r["edited_fingerprint"]] == [*fingerprints.told(mine), *fingerprints.told(edited)]
        assert [r["near_edited"], r["near_next"]] == pytest.approx([fingerprints.likeness(mine, edited)[0], fingerprints.likeness(mine, following)[0]])
    long = [r for r in got.values() if r["n_chars"] > 500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)
    made = {(r["doc_id"], r["text"]): r["fingerprint"] for r in fingerprints.fingerprints(edge).collect()}
    assert made[1, edge.where("doc_id = 1").first()["text"]] == made[2, edge.where("doc_id = 1").first()["text"]]
    assert fingerprints.compared(edge).count() == edge.count()
    assert fingerprints.compared(none).count() == 0
    one = fingerprints.compared(edge.where("doc_id = 8")).first()
    assert one["near_next"] == 1.0


def test_equal_substrings_share_phrases():
    rng = random.Random(9)
    inner = bytes(rng.randrange(97, 123) for _ in range(3000))
    a, b = (bytes(rng.randrange(97, 123) for _ in range(n)) + inner for n in (11, 508))
    assert fingerprints.likeness(*fingerprints.bins([a, b])) > 0.7


# --- licenses


def test_licenses(spark, docs, edge, none):
    rows = docs.union(edge)
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.labelled(rows).collect())
    want = collections.Counter()
    for r in rows.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        want[r["doc_id"], len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    assert got == want
    assert licenses.labelled(none).count() == 0


def test_license_notices_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = sorted({w for ts in licenses.TEMPLATES.values() for t in ts for w in licenses.words(t)})
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(3):
            t = licenses.words(rng.choice([t for ts in licenses.TEMPLATES.values() for t in ts]))
            w = [x for x in t if rng.random() > 0.12 * rng.random()] + rng.choices(vocabulary, k=rng.randrange(3))
            rng.shuffle(w)
            lines.append(" ".join(w))
        texts.append("\n".join(lines))
    got = {r["doc_id"]: {n["template"] for n in r["notices"]} for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    sets = [set(licenses.words(t)) for ts in licenses.TEMPLATES.values() for t in ts]
    for i, text in enumerate(texts):
        want = {k for k, s in enumerate(sets) if any(len(s & set(licenses.words(line))) >= licenses.CONTAINMENT * len(s) - 1e-9 for line in text.split("\n"))}
        assert got[i] == want


def test_license_notices_wrapped_over_lines(spark):
    """Templates wrapped over lines, in plain text and in comments, with one word in twelve lost."""
    rng = random.Random(7)
    templates = [(label, t) for label, ts in licenses.TEMPLATES.items() for t in ts]
    sets = [set(licenses.words(t)) for _, t in templates]
    prose = lambda n: " ".join(f"prose{rng.randrange(500)}" for _ in range(n))
    rows, want = [], {}
    for _, t in templates:
        w = t.split()
        for mark in ("", "# ", " * ", "// "):
            for width in (2, 5, 12):
                for before in (0, 7, 35, 90):
                    kept = [x for x in w if rng.random() > 1 / 12] if width == 12 else w
                    lines = [mark + " ".join(kept[i : i + width]) for i in range(0, len(kept), width)]
                    # lines before and after, without the empty lines that would show a paragraph
                    rows.append((len(rows), "\n".join([mark + prose(before), *lines, mark + prose(20)])))
                    held = set(licenses.words(" ".join(kept)))
                    want[len(rows) - 1] = {j for j, s in enumerate(sets) if len(s & held) >= licenses.CONTAINMENT * len(s) - 1e-9}
    got = {r["doc_id"]: {n["template"] for n in r["notices"]} for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(map(bool, want.values())) > 400
    assert got == want
    # words of a template that stand on several lines in another order are no notice
    words = licenses.words(templates[-1][1])[::-1]
    text = "\n".join(" ".join(words[i : i + 4]) for i in range(0, len(words), 4))
    grant = templates[4][1].split()
    twice = "\n".join([" ".join(grant[:12]), " ".join(grant[12:]), prose(100), " ".join(grant[:9]), " ".join(grant[9:])])
    rows = licenses.scan(spark.createDataFrame([(1, text), (2, twice)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert rows[0]["notices"] == []
    n = len(licenses.words(templates[4][1]))
    assert sorted((x["first_word"], x["last_word"], x["share"]) for x in rows[1]["notices"]) == [(0, n - 1, 1.0), (n + 100, 2 * n + 99, 1.0)]


# --- suffixes


def brute_removal(rows):
    seen, out = [], {}
    for doc_id, text in sorted(rows):
        b = (text or "").encode()
        earlier = set().union(*(s for d, s in seen if d < doc_id)) if seen else set()
        mine = [b[k : k + 50] for k in range(len(b) - 49)]
        gone = bytearray(len(b))
        for k, s in enumerate(mine):
            if s in earlier:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[doc_id] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
        seen.append((doc_id, set(mine)))
    return out


def test_suffixes(spark, edge, none):
    rng = random.Random(8)
    piece = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared_ = [piece(n) for n in (49, 50, 51, 60, 90, 300)] + ["a" * 120, "xyz" * 40]
    rows = [(i, piece(rng.randrange(40)) + "".join(rng.choice(shared_) + piece(rng.randrange(30)) for _ in range(3))) for i in range(60)] + [(100, None), (101, ""), (102, "x" * 49)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_removal(rows)
    assert suffixes.deduplicated(none).count() == 0
    repeated = [r for r in suffixes.deduplicated(edge).collect() if r["doc_id"] == 2]
    assert len(repeated) == 2 and all(r["n_removed"] == r["n_bytes"] for r in repeated)


def test_suffixes_repeated_within_a_document(spark):
    """Every place of a repeated line or a long run of one character goes, not only the first of its document."""
    rng = random.Random(12)
    piece = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = piece(59) + "\n"
    found = spark.createDataFrame([(1, "head of one " + line + "tail of one"), (2, line * 8)], "doc_id bigint, text string")
    assert suffixes.deduplicated(found).where("doc_id = 2").first()["n_removed"] == 480
    dashes = spark.createDataFrame([(1, "-" * 60), (2, "-" * 480)], "doc_id bigint, text string")
    assert suffixes.deduplicated(dashes).where("doc_id = 2").first()["n_removed"] == 480
    lines = [piece(n) + "\n" for n in (40, 52, 60, 75)] + ["-" * 70, "=" * 300, "ab" * 90]
    rows = [(i, piece(rng.randrange(40)) + "".join(rng.choice(lines) * rng.randrange(1, 9) + piece(rng.choice([0, 0, 3, 30])) for _ in range(4))) for i in range(40)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_removal(rows)


@pytest.mark.parametrize("small", [False, True])
def test_suffixes_of_copies(spark, monkeypatch, small):
    """Copies, edited copies and shared passages, in runs of any size."""
    if small:
        for name, n in (("RUN", 60), ("RUN_HASHES", 100), ("BATCH", 700), ("_PIECE", 64)):
            monkeypatch.setattr(suffixes, name, n)
    rng = random.Random(13)
    piece = lambda n: "".join(rng.choice("abcdefghijklmno é") for _ in range(n))
    base, passage = piece(700), piece(130)
    rows = []
    for i in range(80):
        k = rng.randrange(len(base))
        rows.append((i, [base, base[:k] + piece(3) + base[k:], base[k:], piece(200) + passage + piece(50), piece(90), passage * 2][rng.randrange(6)]))
    rng.shuffle(rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()}
    assert got == brute_removal(rows)


def test_merge_of_runs():
    rng = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(suffixes.LENGTH)) if rng.random() > 0.3 else b"a" * 50 for _ in range(rng.randrange(1, 30))) for _ in range(k)]
        coded = [suffixes.front_coded(np.frombuffer(b"".join(r), np.uint8).reshape(-1, 50)) for r in runs]
        for r, (same, rest) in zip(runs, coded, strict=True):
            assert suffixes.decoded(same.astype(int), rest, 50).tobytes() == b"".join(r)
        order, shared = suffixes.merged([(same.tolist(), r) for r, (same, _) in zip(runs, coded, strict=True)], 50)
        rows = [x for r in runs for x in r]
        out = [rows[i] for i in order]
        assert out == sorted(rows) and sorted(order) == list(range(len(rows)))
        for a, b, n in zip(out, out[1:], shared[1:], strict=False):
            assert a[:n] == b[:n] and (n == 50 or a[n] != b[n])


# --- secrets, toxicity, chat


def test_secrets(spark, docs, edge, none):
    forest = secrets.fit(secrets.labelled_findings(spark))
    found = {r["doc_id"]: r for r in secrets.findings(docs, forest, "source").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for k, t in texts.items():
        want = {m[1] for m in re.finditer(r'token = "([0-9a-f]{40})"', t or "")}
        assert want <= {s["secret"] for s in found[k]["secrets"]}
        for s in found[k]["secrets"]:
            assert t[s["start"] - 1 :].startswith(s["secret"])
    clean = secrets.redacted(edge.withColumn("__id", F.lit(1)), forest, "source")
    assert clean.columns == [*edge.columns, "__id"] and clean.count() == edge.count()
    assert sorted(str(r["text"]) for r in clean.collect()) == sorted(str(r["text"]) for r in edge.collect())
    one = spark.createDataFrame([(1, 'a token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" b', 9)], "doc_id bigint, text string, n_chars bigint")
    assert secrets.redacted(one, forest).first()[1:] == ('a token = "[SECRET]" b', 22)
    assert secrets.redacted(none, forest).count() == 0
    plan = secrets.findings(docs, forest, "source")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_forest_on_held_out_findings(spark):
    rows = secrets.labelled_findings(spark, 4000)
    split = F.pmod(F.xxhash64("candidate"), F.lit(4)) == 0
    forest = secrets.fit(rows.where(~split))
    values = secrets.features(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"))
    right = rows.where(split).select(((forest.votes([values[f] for f in secrets.FEATURES]) >= 0.5) == (F.col("label") == 1)).cast("int").alias("ok"))
    assert right.agg(F.avg("ok")).first()[0] > 0.93


def test_toxicity(spark, none, edge):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.judged(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 500 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in got)
    assert sum(r["predicted"] == r["toxic"] for r in got) > 0.95 * len(got)
    caught = [r["predicted"] for r in got if r["toxic"]]
    assert sum(caught) >= 0.9 * len(caught)
    assert sum(r["predicted"] for r in got if not r["toxic"]) < 0.01 * len(got)
    some = labels.limit(50)
    assert toxicity.judged(edge, some).count() == edge.count()
    assert toxicity.judged(none, some).count() == 0
    named = edge.withColumn("SCORE", F.lit(7)).withColumn("score_", F.lit(8))
    assert toxicity.kept(named, some).columns == named.columns and toxicity.kept(named, some).first()["SCORE"] == 7
    assert toxicity.judged(edge, some.where("false")).agg(F.sum("predicted")).first()[0] == 0


def test_chat(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = chat.reported(turns).collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["n_right"] for r in held) > 0.85 * sum(r["n_lines"] for r in held)
    lines = chat.transcripts(turns)
    plain = spark.createDataFrame([(1, 0, 0, 0, "User: hi there"), (1, 0, 0, 1, "more of it"), (1, 0, 0, 2, "Assistant: hello"), (1, 0, 0, 3, None)], "conv_id bigint, part bigint, segment bigint, place bigint, line string")
    parsed = chat.rendered(chat.parse(plain, chat.fit(lines))).orderBy("turn").collect()
    assert [r["role"] for r in parsed][:2] == ["user", "assistant"] and parsed[0]["canonical"] == "<|user|>\nhi there\nmore of it\n<|end|>"
    odd = spark.createDataFrame([(None, None, None, None), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 500, "bot", "")], turns.schema)
    odd = {r["conv_id"]: r for r in chat.reported(odd).collect()}
    assert odd.keys() == {None, 1, 2} and odd[1]["n_lines"] == 2  # equal rows are as many turns
    assert chat.reported(turns.limit(0).unionByName(spark.createDataFrame([(None, i, "user", f"t{i}") for i in range(7)], turns.schema))).count() == 7
    assert chat.reported(turns.where("false")).count() == 0


def test_chat_in_segments_is_as_likely_as_the_whole(spark):
    """Conversations cut anywhere, within turns too, have a path of the same likelihood as when they are whole (equally likely ones are many), and its turns are put together again."""
    rng = random.Random(21)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "\n".join(rng.choice(["what is it?", "a line of text", "", "x" * 90, "Bot: no"]) for _ in range(rng.randrange(1, 4)))) for c in range(12) for t in range(rng.randrange(1, 40))]
    lines = chat.transcripts(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    model = chat.fit(lines)
    ranked = lines.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("place")))
    score = lambda path, seen: model.start[path[0]] + model.shows[path[0], seen[0]] + sum(model.step[a, b] + model.shows[b, x] for a, b, x in zip(path, path[1:], seen[1:], strict=False))
    for size in (2, 5, 1000):
        cut = ranked.withColumn("segment", F.floor(F.col("place") / size).cast("bigint")).cache()
        seen = chat.observed(cut).withColumn("seen", F.col("marker") * len(chat.FORMS) + F.col("form"))
        at = {(r["conv_id"], r["segment"]): (r["before"], r["last"]) for r in chat.borders(seen, model).collect()}
        held = collections.defaultdict(lambda: collections.defaultdict(list))
        for r in sorted(seen.collect(), key=lambda r: r["place"]):
            held[r["conv_id"]][r["segment"]].append(r["seen"])
        turns = collections.defaultdict(list)
        for r in sorted(chat.parse(cut, model).collect(), key=lambda r: r["turn"]):
            turns[r["conv_id"]].append(r)
        for conv, segments in held.items():
            path = [s for k, v in sorted(segments.items()) for s in model.viterbi(np.array(v), *at.get((conv, k), (None, None)))]
            whole = [x for _, v in sorted(segments.items()) for x in v]
            assert abs(score(path, whole) - score(model.viterbi(np.array(whole)), whole)) < 1e-6
            opens = [k for k, s in enumerate(path) if s % 2 == 0]
            assert [r["turn"] for r in turns[conv]] == list(range(len(opens)))
            assert [r["role"] for r in turns[conv]] == [chat.ROLES[path[k] // 2] for k in opens]
            assert [r["n_lines"] for r in turns[conv]] == np.diff([*opens, len(path)]).tolist()


def test_viterbi_equals_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    m = chat.Model(rng.random(6), rng.random((6, 6)), rng.random((6, chat.N_SEEN)))
    seen = rng.integers(0, chat.N_SEEN, 5)
    value = lambda p: m.start[p[0]] + m.shows[p[0], seen[0]] + sum(m.step[a, b] + m.shows[b, x] for a, b, x in zip(p, p[1:], seen[1:], strict=False))
    assert m.viterbi(seen) == list(max(itertools.product(range(6), repeat=5), key=value))


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = out.collect()
    assert set(docs.columns) < set(out.columns) and 0.5 * docs.count() < len(rows) <= docs.count()
    assert not any(re.search(r'token = "[0-9a-f]{40}"', r["text"] or "") for r in rows)
    texts = [r["text"] for r in rows if r["text"]]
    assert len(set(texts)) == len(texts)
    own = bpe.tokenizer(bpe.default_vocabulary())
    assert all(r["n_tokens"] == len(own.encode([r["text"] or ""])[0]) // 4 for r in rows[:20])


def test_pipeline_stages_on_odd_rows(spark, edge, none, tmp_path):
    """Nulls, empty texts, repeated rows, a very long text, columns with clashing names, and tables without rows."""
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    clashing = edge.withColumns({c: F.lit(c) for c in ("leaks", "score", "__parts", "__found", "copy_id", "node", "__copy", "SECRETS")})
    for docs in (edge, clashing, none):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            left = collections.Counter(str(tuple(r)) for r in out.collect())
            if name == "near_duplicates":
                assert sorted(r["doc_id"] or 0 for r in out.collect()) == ([0, 1, 3, 4, 5, 6, 8, 9] if docs is not none else [])
            else:  # these rows are clean: none goes and none is changed
                assert left == collections.Counter(str(tuple(r)) for r in docs.collect()), name
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert set(docs.columns) < set(out.columns) and out.count() == docs.count()
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
    for name, stage in corpus_pipeline.STAGES[:3:2]:
        assert stage(spark, edge, f"{tmp_path}/none").count() == edge.count(), name


def test_pipeline_decisions_take_effect(spark, tmp_path):
    """What each stage decides holds for what it is given: toxic texts, all but the first of near copies, leaks and secrets go, and nothing else does."""
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sf = "/root/testdata/sf0.01"
    stages = dict(corpus_pipeline.STAGES)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    assert {r["doc_id"] for r in stages["toxicity"](spark, docs, sf).collect()} == {i for i, s in scores.items() if s < 0.5}
    components = brute_components(sets_of(rows, 5), 80)
    assert {r["doc_id"] for r in stages["near_duplicates"](spark, docs, sf).collect()} == {i for i, c in components.items() if i == c}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in stages["decontamination"](spark, docs, sf).collect()}
    holders = {i for i, t in rows if any(x in t for x in items)}
    assert not clean & holders and len(clean) >= 0.99 * (len(rows) - len(holders))
    texts = {r["doc_id"]: r["text"] for r in stages["secrets"](spark, docs, sf).collect()}
    planted = {i: re.findall(r'token = "([0-9a-f]{40})"', t) for i, t in rows}
    assert not any(x in texts[i] for i, found in planted.items() for x in found)
    assert sum(texts[i] == t for i, t in rows if not planted[i]) >= 0.99 * sum(not found for found in planted.values())


def test_jaccard_counters_stay_off_the_driver(spark):
    """The driver gets a byte for each counter, not the sums, and ranks follow the counts."""
    frame = spark.createDataFrame([(i, f"a b c d e word{i} f{i % 3}") for i in range(40)], "doc_id bigint, text string")
    jaccard.nodes_of(frame.limit(1), 2)
    tracemalloc.start()
    try:
        rows, ranks = jaccard.nodes_of(frame, 2)
        assert tracemalloc.get_traced_memory()[1] < 5 * jaccard.COUNTERS
    finally:
        tracemalloc.stop()
    assert rows.count() == 40 and ranks.shape == (jaccard.COUNTERS,)
    counts = collections.Counter(int(h) for s in jaccard.shingles([r["text"] for r in frame.collect()], 2) for h in s & np.uint64(jaccard.COUNTERS - 1))
    pairs = sorted((n, int(ranks[h])) for h, n in counts.items())
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:], strict=False)) and pairs[0][1] < pairs[-1][1]


def test_jaccard_ranks_of_counts():
    rng = np.random.default_rng(5)
    for counts in (np.zeros(99, np.int64), np.full(9, 7), np.concatenate([rng.integers(0, 50, 9000), rng.zipf(1.3, 9000).clip(max=1 << 40)])):
        low = jaccard.coarse(counts)
        assert ((low <= counts) & (counts - low <= counts >> 9)).all() and (low[counts < 1024] == counts[counts < 1024]).all()
        ranks = jaccard.ranked(counts, jaccard.edges_of(*np.unique(low[low > 0], return_counts=True)))
        assert (np.diff(ranks[np.argsort(counts, kind="stable")].astype(int)) >= 0).all()
    assert len(np.unique(ranks)) > 60
    assert len(np.unique(jaccard.coarse(np.arange(1 << 20)))) < 8192


def test_jaccard_bitmaps_keep_unlike_sets_apart():
    """Sets with little in common seldom pass the bound of bitmaps, alone and in a tree that a much larger set is in too; like ones always do."""
    rng = np.random.default_rng(8)
    new = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    for n in (48, 64, 250, 512):
        common = new(n // 5)
        sets = [np.unique(np.concatenate([common, new(n - len(common))])) for _ in range(40)]
        assert not any(jaccard.pair_may_link(n, n, jaccard.bitmap(a), jaccard.bitmap(b), 80) for a, b in itertools.combinations(sets, 2))
        sets += [new(40 * n), np.append(sets[3][:-2], new(2)), new(40 * n)]
        size = np.array([len(s) for s in sets])
        maps = [np.frombuffer(jaccard.bitmap(s), np.uint64) for s in sets]
        tree = jaccard.Tree.of_bitmaps(maps, size, max(map(len, maps)))
        labels = np.arange(len(sets))
        assert [sorted(x) for x in jaccard.tree_links(tree, tree, labels, labels, 80)] == [[3, 41]]


def test_jaccard_deals_large_groups_in_rounds(spark, monkeypatch):
    """Blocks of a group that is cut never pass all at once, and links stay whole."""
    monkeypatch.setattr(jaccard, "GROUP_NODES", 8)
    monkeypatch.setattr(jaccard, "ROUND_SHINGLES", 1)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 57 - i % 4], rng.integers(0, 2**64, 3, dtype=np.uint64)])) for i in range(48)]
    brute = spark.createDataFrame([(a, b) for a, b in itertools.combinations(range(48), 2) if jaccard.linked(sets[a], sets[b], 85)] or [(0, 0)], "a bigint, b bigint")
    passed, compared = [], jaccard._compared

    def watched(rows, *rest):
        passed.append(rows.agg(F.sum("n")).first()[0] or 0)
        return compared(rows, *rest)

    monkeypatch.setattr(jaccard, "_compared", watched)
    members = spark.createDataFrame([(0, i, len(s), i) for i, s in enumerate(sets)], "g bigint, node bigint, n bigint, label bigint")
    data = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "node bigint, data binary")
    links = jaccard.links_within(members, data, 85)
    assert sorted(shared.components(links).collect()) == sorted(shared.components(brute).collect())
    assert len(passed) > 4 and max(passed) <= 2 * sum(map(len, sets))


def test_jaccard_size_classes_hold_all_pairs(spark):
    rows = spark.createDataFrame([(1, n, n, n) for n in [*range(1, 400), 9_999, 12_000]], "g bigint, node bigint, n bigint, label bigint")
    for percent in (80, 85, 100):
        classes = collections.defaultdict(set)
        for r in jaccard._by_size(rows, percent).collect():
            classes[r["g"]].add(r["n"])
        together = {p for c in classes.values() for p in itertools.combinations(sorted(c), 2)}
        sizes = [r["n"] for r in rows.collect()]
        assert {(a, b) for a, b in itertools.combinations(sizes, 2) if 100 * a >= percent * b} <= together
        assert percent == 100 or all(max(c) * percent * percent <= 10_001 * min(c) for c in classes.values())
