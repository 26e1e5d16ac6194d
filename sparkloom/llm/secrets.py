"""Secret scans: candidates by pattern, false positives removed by a random forest; DataFrame functions only.

The forest is trained on labelled findings and then written as a Column expression, so a scan is
one projection: no text is shuffled and nothing runs outside the JVM.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import free_name

#: Long runs of the letters that keys and tokens are made of.
CANDIDATE = r"[A-Za-z0-9+/_=~.\-]{16,}"
MARK = "\x01"
#: Characters of context on either side.
CONTEXT = 48
#: Pieces of ordinary words of the languages at hand, for dictionary coverage. Fixed values.
WORD_PIECES = (
    "tion|ment|ing|the|and|ung|keit|heit|lich|sch|eit|ent|est|ion|eur|eau|eux|elle|que|pour|des|les|der|die|das|ein|und|nicht|ado|ido|cion|mente|los|las|que|con|"
    "for|with|that|this|here|ther|hand|and|are|was|ver|ter|ter|ear|ou|an|en|er|in|on|re|at|es|ed|st|nd|th|ha|ly|is|or|ti|le|de|la|el|ar|ra|te|ch|au|ai|oi|ai|ez|os|as|bo|mi|ue|ge|be|zu"
)
KEY_WORDS = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer|signing)"
OTHER_WORDS = r"(?i)(sha|md5|commit|checksum|digest|uuid|isbn|phone|card|order|invoice|version|http|www|href|src=)"
TREES, DEPTH = 15, 6
#: Votes of trees, as a share, from which on a candidate counts as a secret.
VOTES = 0.5
FEATURES = ("length", "transitions", "digits", "capitals", "coverage", "distinct", "hexadecimal", "key_word", "assigned", "other_word", "path", "separators", "test_path")


def features(candidate: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    """Of a candidate, its neighbouring words and the path or source of its document."""
    n = F.length(candidate).cast("double")
    low = F.lower(candidate)
    share = lambda pattern, c=candidate: F.regexp_count(c, F.lit(pattern)) / n
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return {
        "length": n,
        "transitions": share(r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
        "digits": share("[0-9]"),
        "capitals": share("[A-Z]"),
        "coverage": 1 - F.length(F.regexp_replace(low, WORD_PIECES, "")) / n,
        "distinct": F.size(F.array_distinct(F.split(candidate, ""))) / F.least(n, F.lit(64.0)),
        "hexadecimal": flag(low.rlike("^[0-9a-f]+$") & low.rlike("[a-f]") & low.rlike("[0-9]")),
        "key_word": flag(before.rlike(KEY_WORDS + r"[^A-Za-z]*$") | candidate.rlike("^(AKIA|ghp_|sk-|sk_|xox|AIza|eyJ)")),
        "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")),
        "other_word": flag(before.rlike(OTHER_WORDS + r"[^A-Za-z]*$") | candidate.rlike("^(www|http)")),
        "path": share("[/.]"),
        "separators": share("[-_=+~]"),
        "test_path": flag(path.rlike("(?i)(test|example|fixture|sample|mock|doc)s?[/._-]")),
    }


def labelled_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """Findings with labels to train on when no audited ones are at hand: n rows (candidate, before, after, path, label), the same each time.

    Half are random keys of usual shapes, mostly where a key is assigned; half are what patterns
    find besides: compound words, paths, host names, digit runs, dates, digests, repeated letters
    and placeholders, some of them after a key word too.
    """
    i = F.col("id")
    h = F.sha2(i.cast("string"), 512)
    other = F.sha2(F.concat(i.cast("string"), F.lit("x")), 512)
    pick = lambda k, m: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(m))
    base64 = F.regexp_replace(F.base64(F.unhex(h)), "[+/=]", "")
    base64_all = F.regexp_replace(F.base64(F.unhex(other)), "[\\s]", "")
    pieces = F.split(F.lit(WORD_PIECES), r"\|")
    word = F.array_join(F.transform(F.sequence(F.lit(1), (6 + pick(1, 8)).cast("int")), lambda k: F.element_at(pieces, (1 + F.pmod(F.xxhash64(i, k), F.size(pieces).cast("bigint"))).cast("int"))), "")
    secret = (
        F.when(pick(2, 8) == 0, F.concat(F.lit("AKIA"), F.substring(F.upper(base64), 1, 16)))
        .when(pick(2, 8) == 1, F.concat(F.lit("ghp_"), F.substring(base64, 1, 36)))
        .when(pick(2, 8) == 2, F.concat(F.lit("sk-"), F.substring(base64, 1, 48)))
        .when(pick(2, 8) == 3, F.substring(base64_all, 1, 40))
        .when(pick(2, 8) == 4, F.substring(base64, 1, 32))
        .otherwise(F.expr("substring(sha2(cast(id as string), 512), 1, cast(element_at(array(32, 40, 40, 64), cast(pmod(id, 4) + 1 as int)) as int))"))
    )
    noise = (
        F.when(pick(3, 10) <= 2, word)
        .when(pick(3, 10) == 3, F.concat_ws("/", F.lit("usr"), F.substring(word, 1, 6), F.substring(word, 5, 7), F.lit("index.html")))
        .when(pick(3, 10) == 4, F.concat(F.lit("www."), F.substring(word, 1, 9), F.lit(".example.com")))
        .when(pick(3, 10) == 5, F.lpad(F.abs(F.xxhash64(i)).cast("string"), 16, "4"))
        .when(pick(3, 10) == 6, F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 12)))
        .when(pick(3, 10) == 7, F.substring(h, 1, 40))
        .when(pick(3, 10) == 8, F.repeat(F.substring(F.lit("xX*0=-_.#a"), (1 + pick(4, 9)).cast("int"), 1), (16 + pick(5, 30)).cast("int")))
        .otherwise(F.concat_ws("_", F.lit("YOUR"), F.upper(F.substring(word, 1, 6)), F.lit("TOKEN_HERE")))
    )
    word_before = F.concat(F.substring(word, 3, 5), F.lit(" "))
    keyed = F.concat(word_before, F.element_at(F.array(*map(F.lit, ("token", "secret_key", "api_key", "password", "Authorization: Bearer", "aws_secret_access_key"))), (1 + pick(6, 6)).cast("int")), F.element_at(F.array(*map(F.lit, (" = \"", "=", ": ", " = '", " "))), (1 + pick(7, 5)).cast("int")))
    told = F.concat(word_before, F.element_at(F.array(*map(F.lit, ("commit ", "sha1: ", "uuid ", "checksum = ", "order ", "http://", ""))), (1 + pick(8, 7)).cast("int")))
    label = (i % 2).cast("double")
    plain_digest = (label == 0) & (pick(3, 10) == 7)
    before = F.when(label == 1, F.when(pick(9, 10) < 9, keyed).otherwise(word_before)).otherwise(F.when(plain_digest, told).when(pick(9, 10) < 2, keyed).otherwise(F.when(pick(9, 10) < 5, told).otherwise(word_before)))
    path = F.when(pick(10, 12) == 0, F.lit("tests/fixtures/")).otherwise(F.lit("src"))
    rows = spark.range(n).select(F.when(label == 1, secret).otherwise(noise).alias("candidate"), before.alias("before"), F.lit("\" ").alias("after"), path.alias("path"), label.alias("label"))
    return rows.where(F.length("candidate") >= 16)


class Forest:
    """A random forest as a Column expression over named features."""

    def __init__(self, debug: str):
        self.trees = [self._tree(t) for t in re.split(r"(?m)^\s*Tree \d+.*$", debug)[1:]]

    @staticmethod
    def _tree(text: str):
        lines = iter([x.strip() for x in text.splitlines() if x.strip()])

        def node():
            line = next(lines)
            if line.startswith("Predict"):
                return float(line.split(":")[1])
            feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
            left = node()
            next(lines)  # Else
            return int(feature), float(threshold), left, node()

        return node()

    def votes(self, values: list[Column]) -> Column:
        def of(n) -> Column:
            if isinstance(n, float):
                return F.lit(n)
            return F.when(values[n[0]] <= n[1], of(n[2])).otherwise(of(n[3]))

        total = of(self.trees[0])
        for t in self.trees[1:]:
            total = total + of(t)
        return total / len(self.trees)


def fit(findings: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Forest:
    """A forest from labelled findings (candidate, before, after, path, label)."""
    values = features(F.col("candidate"), F.col("before"), F.col("after"), F.col("path"))
    rows = findings.select("label", *[c.alias(k) for k, c in values.items()])
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features").repartition(1)
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5, cacheNodeIds=False).fit(rows)
    return Forest(model.toDebugString)


def _parts(text: str) -> Column:
    """The text split at candidates, which stand at even places."""
    return F.split(F.regexp_replace(F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), MARK, " "), f"({CANDIDATE})", f"{MARK}$1{MARK}"), MARK)


def _judged(parts: Column, forest: Forest, where: Column) -> Column:
    """Of each candidate among parts: candidate, place and score."""
    part = lambda k: F.element_at(parts, k)

    def one(k: Column) -> Column:
        before, after = F.substring(part(k - 1), F.greatest(F.length(part(k - 1)) - CONTEXT + 1, F.lit(1)), F.lit(CONTEXT)), F.substring(part(k + 1), 1, CONTEXT)
        values = features(part(k), before, after, where)
        return F.struct(part(k).alias("candidate"), k.alias("place"), *[values[f].alias(f) for f in FEATURES])

    places = F.when(F.size(parts) > 1, F.sequence(F.lit(2), F.size(parts) - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    return F.transform(F.transform(places, one), lambda x: F.struct(x["candidate"].alias("candidate"), x["place"].alias("place"), forest.votes([x[f] for f in FEATURES]).alias("score")))


def scan(docs: DataFrame, forest: Forest, path: str | None = None, text: str = "text", column: str = "candidates", parts: str | None = None) -> DataFrame:
    """docs with an array of (candidate, place, score) of every candidate in the whole text, in a column (replaced if there); empty for a null text. parts: a column for the pieces of the text between which places count."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    pieces = parts or free_name(docs, "parts")
    rows = docs.withColumn(pieces, _parts(text))
    rows = rows.withColumn(column, _judged(F.col(pieces), forest, where))
    return rows if parts else rows.drop(pieces)


def findings(docs: DataFrame, forest: Forest, path: str | None = None, text: str = "text") -> DataFrame:
    """docs with n_candidates and secrets, an array of (start, secret, score): the candidates for which enough trees vote. start counts characters from 1; columns of these names are replaced."""
    parts, candidates = free_name(docs, "parts"), free_name(docs, "candidates")
    rows = scan(docs, forest, path, text, candidates, parts)
    # where each piece begins: a running sum, made once for a text
    begins = F.aggregate(parts, F.array(F.lit(1).cast("bigint")), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + F.length(p))))
    found = F.filter(candidates, lambda x: x["score"] >= VOTES)
    begin = free_name(rows, "begins")
    rows = rows.withColumn(begin, F.when(F.size(found) > 0, begins))
    secrets = F.transform(found, lambda x: F.struct(F.element_at(begin, x["place"]).alias("start"), x["candidate"].alias("secret"), x["score"].alias("score")))
    return rows.withColumns({"n_candidates": F.size(candidates).cast("bigint"), "secrets": secrets}).drop(parts, candidates, begin)


def redacted(docs: DataFrame, forest: Forest, path: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret of the text replaced by a mask, and n_chars, where there is such a column, counted anew.

    Texts without secrets stay as they are, null and empty ones too; in others, characters U+0001
    become blanks. Repeated rows and all other columns stay.
    """
    parts, candidates = free_name(docs, "parts"), free_name(docs, "candidates")
    rows = scan(docs, forest, path, "text", candidates, parts)
    bad = free_name(rows, "bad")
    rows = rows.withColumn(bad, F.transform(F.filter(candidates, lambda x: x["score"] >= VOTES), lambda x: x["place"]))
    clean = F.array_join(F.transform(parts, lambda p, i: F.when(F.array_contains(bad, i + 1), F.lit(mask)).otherwise(p)), "")
    rows = rows.withColumn("text", F.when(F.size(bad) > 0, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.size(bad) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def reported(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_candidates, n_secrets, and starts and secrets joined by commas. One row for each row; null and empty texts have none."""
    forest = fit(labelled_findings(docs.sparkSession))
    found = findings(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source"), forest, "source")
    return found.select(
        "doc_id",
        "n_candidates",
        F.size("secrets").cast("bigint").alias("n_secrets"),
        F.array_join(F.transform("secrets", lambda x: x["start"].cast("string")), ",").alias("starts"),
        F.array_join(F.transform("secrets", lambda x: x["secret"]), ",").alias("secrets"),
    )
