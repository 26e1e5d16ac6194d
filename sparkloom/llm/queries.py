"""The operators over the standard tables, as queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text of documents, by the forest fitted on labelled findings. Null and empty texts have none; one row for each row."""
    from . import secrets

    return secrets.reported(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of documents and the text decoded from them, as digests. A null text is empty; one row for each row."""
    from . import bpe

    return bpe.digests(_table(spark, sf_dir, "documents"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a likeness of 0.85. Texts without words link with nothing; jobs run when this is called."""
    from . import jaccard

    return jaccard.connected(_table(spark, sf_dir, "documents"), 4, 85)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every whole text of documents. Null and empty texts and items leak nothing; two passes run when this is called."""
    from . import decontaminate

    return decontaminate.reported(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages written as WARC archives with an index and read back. Null html is an empty payload; jobs run when this is called."""
    from . import warc

    return warc.write_and_read(_table(spark, sf_dir, "pages"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text of documents and of its edited text, and their likeness. A null text is empty."""
    from . import fingerprints

    return fingerprints.compared(_table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of the lines of conversations, written as transcripts, parsed by the hidden Markov model fitted on the others. Null turns and texts stay as lines without role."""
    from . import chat

    return chat.reported(_table(spark, sf_dir, "conversations"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices of licenses in every whole text of documents. A null text has no words; one counting pass runs when this is called."""
    from . import licenses

    return licenses.labelled(_table(spark, sf_dir, "documents"))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes of documents that an earlier document has, removed. A null text is empty, rows without doc_id are left out; jobs run when this is called."""
    from . import suffixes

    return suffixes.deduplicated(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text of documents, by a model of the labels that are not held out. A null text scores as an empty one; the model is fitted when this is called."""
    from . import toxicity

    return toxicity.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secrets, op2_bpe, op3_jaccard, op4_decontaminate, op5_warc, op6_fingerprints, op7_chat, op8_licenses, op9_suffixes, op10_toxicity)}


#: Components of all pairs of texts that link, by recursion.
_OP3 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM parts a JOIN parts b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, (SELECT min(r.b) FROM reach r WHERE r.a = s.doc_id) AS component_id FROM sets s
"""
#: SHA-1 in hexadecimal digits, as bits, as base32 digits.
_OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, array_to_string(list_transform(string_split(sha1(h), ''), lambda x: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', x)]), '') AS bits,
  min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum(list_transform(range(0, 5), lambda k: CAST(substr(bits, 5 * i + k + 1, 1) AS INTEGER) * (1 << (4 - k)))) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""
#: Strings of 50 bytes are 100 hexadecimal digits; texts are cut into parts of 1,000 first places, which makes substrings cheap.
_OP9 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
c AS (SELECT doc_id, k, substr(h, CAST(2000 * k + 1 AS INTEGER), 2100) AS part, least(1000, n - 49 - 1000 * k) AS m FROM (SELECT *, unnest(range(0, (greatest(n - 49, 0) + 999) // 1000)) AS k FROM b)),
s AS (SELECT doc_id, 1000 * k + i AS i, substr(part, CAST(2 * i + 1 AS INTEGER), 100) AS x FROM (SELECT *, unnest(range(0, m)) AS i FROM c)),
f AS (SELECT x, min(doc_id) AS first FROM s GROUP BY x HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT s.doc_id, s.i FROM s JOIN f USING (x) WHERE s.doc_id > f.first),
runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit)),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 50 AS hi FROM runs GROUP BY doc_id, r),
o AS (SELECT doc_id, lo, hi, lag(hi) OVER (PARTITION BY doc_id ORDER BY lo) AS before FROM spans),
g AS (SELECT o.doc_id, string_agg(substr(b.h, CAST(2 * coalesce(before, 0) + 1 AS INTEGER), CAST(2 * (lo - coalesce(before, 0)) AS INTEGER)), '' ORDER BY lo) AS kept, max(hi) AS last, sum(hi - lo) AS gone, count(*) AS spans FROM o JOIN b USING (doc_id) GROUP BY o.doc_id)
SELECT b.doc_id, CAST(b.n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(b.h, CAST(2 * coalesce(last, 0) + 1 AS INTEGER)))) AS kept_sha256 FROM b LEFT JOIN g USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard": _OP3, "op5_warc": _OP5, "op9_suffixes": _OP9}
