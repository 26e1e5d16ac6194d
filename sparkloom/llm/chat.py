"""Chat formatting: transcripts are parsed by a hidden Markov model and rendered in one form.

A transcript is a sequence of lines. Each line is observed as its speaker marker and its form; the
states are the roles, at the first line of a turn or within it. Probabilities are counted over
transcripts whose roles are known; roles are recovered by Viterbi. A long conversation is dealt
out in segments: each gives its best path between any two states as a matrix, the matrices of a
conversation are chained to the states at the borders, and the segments' paths between those are
the path of the whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import saved

ROLES = ("system", "user", "assistant")
#: Kinds of speaker markers at the start of a line, tried in this order. Fixed values.
MARKERS = (
    ("system", r"(?i)^\s*(?:###\s*|<\|)?(?:system|instructions?)\s*(?:\|>|[:>\]-])\s*"),
    ("user", r"(?i)^\s*(?:###\s*|<\|)?(?:user|human|customer|q(?:uestion)?|you)\s*(?:\|>|[:>\]-])\s*"),
    ("assistant", r"(?i)^\s*(?:###\s*|<\|)?(?:assistant|bot|ai|agent|a(?:nswer)?)\s*(?:\|>|[:>\]-])\s*"),
    ("other", r"^\s*(?:>>+|-{2,}|\*)\s*"),
)
FORMS = ("long", "short", "question", "empty")
#: Turn numbers of a segment.
SEGMENT = 64
#: What names a segment; part tells rows without conv_id apart, each of which is a conversation of its own.
KEY = ("conv_id", "part", "segment")


def marker(line: Column) -> Column:
    """The number of a line's marker, or how many kinds there are if it has none."""
    out = F.lit(len(MARKERS))
    for i, (_, pattern) in reversed(list(enumerate(MARKERS))):
        out = F.when(line.rlike(pattern), F.lit(i)).otherwise(out)
    return out


def without_marker(line: Column) -> Column:
    out = line
    for _, pattern in reversed(MARKERS):
        out = F.when(line.rlike(pattern), F.regexp_replace(line, pattern, "")).otherwise(out)
    return out


def form(line: Column) -> Column:
    return F.when(F.length(F.trim(line)) == 0, 3).when(line.rlike(r"\?\s*$"), 2).when(F.length(line) < 80, 1).otherwise(0)


def observed(lines: DataFrame) -> DataFrame:
    """lines (conv_id, part, segment, place, line, ...) with marker and form."""
    return lines.withColumns({"marker": marker(F.col("line")), "form": form(F.col("line"))})


#: Marker styles in which transcripts come, for each role in the order of ROLES; an empty one leaves the role open. Fixed values.
STYLES = (("System: ", "User: ", "Assistant: "), ("### System: ", "### Human: ", "### AI: "), ("", "Q: ", "A: "), ("<|system|> ", "<|user|> ", "<|assistant|> "), (">> ", ">> ", ">> "))


def transcripts(turns: DataFrame) -> DataFrame:
    """Lines (conv_id, part, segment, place, line, role, opens) of turns (conv_id, turn, role, text) written as plain transcripts.

    A conversation has one of STYLES, by its conv_id; every seventh turn or so lost its marker.
    Turns without a role count as the user's; null texts are empty lines. Equal rows are as many
    turns; turns of an equal number follow each other by role and text.
    """
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role"), F.lit("user")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).drop("n")
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    table = F.create_map(*[F.lit(x) for s, marks in enumerate(STYLES) for r, m in zip(ROLES, marks, strict=True) for x in (f"{s}{r}", m)])
    mark = F.coalesce(table[F.concat(style.cast("string"), F.col("role"))], F.lit(""))
    mark = F.when(F.pmod(F.xxhash64("conv_id", "turn", F.lit("lost")), F.lit(7)) == 0, "").otherwise(mark)
    part = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text", "copy")).otherwise(0)
    segment = F.floor(F.coalesce("turn", F.lit(-1)) / SEGMENT).cast("bigint")  # as null turns come first
    cut = rows.select("conv_id", part.alias("part"), segment.alias("segment"), "turn", "role", "text", "copy", F.posexplode(F.split(F.concat(mark, "text"), "\n")).alias("k", "line"))
    return cut.select(*KEY, F.struct("turn", "role", "text", "copy", "k").alias("place"), "line", "role", (F.col("k") == 0).alias("opens"))


class Model:
    """Logarithms of the probabilities of states and observations."""

    def __init__(self, start: np.ndarray, step: np.ndarray, shows: np.ndarray):
        smooth = lambda c: np.log((c + 0.5) / (c + 0.5).sum(axis=-1, keepdims=True))
        self.start, self.step, self.shows = smooth(start), smooth(step), smooth(shows)
        for s in range(len(start)):  # a turn's line follows a line of the same role
            if s % 2:
                self.start[s] = -1e9
                self.step[[p for p in range(len(start)) if p // 2 != s // 2], s] = -1e9

    def viterbi(self, seen: np.ndarray, before: int | None = None, last: int | None = None) -> list[int]:
        """The likeliest path, after a state and ending in one, if these are given."""
        best, back = (self.start if before is None else self.step[before]) + self.shows[:, seen[0]], []
        for x in seen[1:]:
            total = best[:, None] + self.step
            back.append(total.argmax(axis=0))
            best = total.max(axis=0) + self.shows[:, x]
        path = [int(best.argmax()) if last is None else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def transfer(self, seen: np.ndarray) -> np.ndarray:
        """Logarithms of the likeliest paths: a row for each state before the first line and one, the last, for none; a column for each state at the last line."""
        best = np.vstack([self.step, self.start]) + self.shows[:, seen[0]]
        for x in seen[1:]:
            best = (best[:, :, None] + self.step).max(axis=1) + self.shows[:, x]
        return best


N_SEEN = (len(MARKERS) + 1) * len(FORMS)


def fit(lines: DataFrame) -> Model:
    """A model counted over all lines whose roles are known; as many counts as pairs of states and observations reach the driver."""
    role = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(ROLES) for x in (r, i)]), F.col("role"))
    state = 2 * F.coalesce(role, F.lit(1)) + F.when(F.col("opens"), 0).otherwise(1)
    rows = observed(lines).select(*KEY, "place", state.alias("state"), (F.col("marker") * len(FORMS) + F.col("form")).alias("seen"))

    before = F.lag("state").over(Window.partitionBy(*KEY).orderBy("place"))
    counts = rows.withColumn("before", before).groupBy("before", "state", "seen").agg(F.count(F.lit(1)).alias("n")).collect()
    n = 2 * len(ROLES)
    start, step, shows = np.zeros(n), np.zeros((n, n)), np.zeros((n, N_SEEN))
    for r in counts:
        shows[r["state"], r["seen"]] += r["n"]
        if r["before"] is None:
            start[r["state"]] += r["n"]
        else:
            step[r["before"], r["state"]] += r["n"]
    return Model(start, step, shows)


PARSED = "conv_id bigint, part bigint, turn bigint, role string, text string, n_lines bigint, n_right bigint"


def _in_place(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: tuple((v is not None, v) for v in (r["place"].values() if isinstance(r["place"], dict) else [r["place"]])))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], kinds[k]) for i, (n, k) in enumerate(fields)})


def borders(rows: DataFrame, model: Model) -> DataFrame:
    """(conv_id, part, segment, before, last) of the segments of rows (conv_id, part, segment, place, seen): the states at their borders on the whole's likeliest path. Conversations of one segment have none."""
    several = rows.select(*KEY).distinct().groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND conv_id IS NOT NULL").select("conv_id")
    keys, links = "conv_id bigint, part bigint, segment bigint", "best array<double>"

    def matrix(table: pa.Table) -> pa.Table:
        held = _in_place(table)
        return _table([(*(held[0][k] for k in KEY), model.transfer(np.array([r["seen"] for r in held])).ravel().tolist())], f"{keys}, {links}")

    def chain(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda r: r["segment"])
        n = len(model.start)
        steps = [np.array(r["best"]).reshape(n + 1, n) for r in held]
        best, back = steps[0][n], []
        for m in steps[1:]:
            total = best[:, None] + m[:n]
            back.append(total.argmax(axis=0))
            best = total.max(axis=0)
        ends = [int(best.argmax())]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends.reverse()
        return _table([(*(r[k] for k in KEY), None if i == 0 else ends[i - 1], ends[i]) for i, r in enumerate(held)], f"{keys}, before int, last int")

    found = rows.join(several, "conv_id").select(*KEY, "place", "seen").groupBy(*KEY).applyInArrow(matrix, f"{keys}, {links}")
    return found.groupBy("conv_id", "part").applyInArrow(chain, f"{keys}, before int, last int")


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """Turns (conv_id, part, turn, role, text) recovered from lines (conv_id, part, segment, place, line).

    Segments of a conversation are parsed in different tasks, to the same turns as the whole: a
    turn that goes on over a border is one. Where lines have a known role too, n_right counts the
    lines whose recovered role is that; it is 0 otherwise.
    """
    known = F.col("role") if "role" in lines.columns else F.lit(None).cast("string")
    rows = observed(lines).select(*KEY, "place", (F.col("marker") * len(FORMS) + F.col("form")).alias("seen"), without_marker(F.col("line")).alias("body"), known.alias("known"))
    found = borders(rows, model)
    pieces_schema = "conv_id bigint, part bigint, segment bigint, i bigint, opens boolean, role string, text string, n_lines bigint, n_right bigint"

    def run(table: pa.Table) -> pa.Table:
        held = _in_place(table)
        path = model.viterbi(np.array([r["seen"] for r in held]), held[0]["before"], held[0]["last"])
        pieces: list[list] = []
        n_open = 0
        for r, s in zip(held, path, strict=True):
            n_open += s % 2 == 0
            if s % 2 == 0 or not pieces:
                pieces.append([*(r[k] for k in KEY), n_open - 1, s % 2 == 0, ROLES[s // 2], [], 0, 0])
            pieces[-1][6].append(r["body"] or "")
            pieces[-1][7] += 1
            pieces[-1][8] += r["known"] == ROLES[s // 2]
        return _table([(*p[:6], "\n".join(p[6]), *p[7:]) for p in pieces], pieces_schema)

    same = [F.col(k) == F.col(f"at_{k}") for k in KEY]
    held = rows.join(found.select(*[F.col(k).alias(f"at_{k}") for k in KEY], "before", "last"), same, "left").drop(*[f"at_{k}" for k in KEY])
    pieces = saved(held.groupBy(*KEY).applyInArrow(run, pieces_schema), "pieces")

    def numbered(table: pa.Table) -> pa.Table:
        out, base = [], 0
        for r in sorted(table.to_pylist(), key=lambda r: r["segment"]):
            out.append((*(r[k] for k in KEY), base))
            base += r["n"]
        return _table(out, "conv_id bigint, part bigint, segment bigint, base bigint")

    opened = pieces.groupBy(*KEY).agg(F.count_if("opens").alias("n")).groupBy("conv_id", "part").applyInArrow(numbered, "conv_id bigint, part bigint, segment bigint, base bigint")
    same = [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in KEY]
    placed = pieces.join(opened.select(*[F.col(k).alias(f"at_{k}") for k in KEY], "base"), same)
    # a piece that opens no turn belongs to the last one before it
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "i", "text"))), lambda x: x["text"]), "\n")
    turns = placed.groupBy("conv_id", "part", F.greatest(F.col("base") + F.col("i"), F.lit(0)).alias("turn"))
    return turns.agg(F.min_by("role", F.struct("segment", "i")).alias("role"), F.regexp_replace(text, r"^\s+|\s+$", "").alias("text"), F.sum("n_lines").alias("n_lines"), F.sum("n_right").alias("n_right"))


def rendered(turns: DataFrame) -> DataFrame:
    """turns with a column canonical: <|role|>, a line feed, the text and <|end|>."""
    return turns.withColumn("canonical", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def reported(conversations: DataFrame) -> DataFrame:
    """Per conversation: its turns and lines, those with the right role, and the SHA-256 of the canonical text of its turns in order.

    The model is counted over four fifths of the conversations (crc32 of conv_id not divisible by
    5); held_out marks the others. A row without conv_id is a conversation of its own, with a row
    in the result. Jobs run when this is called.
    """
    lines = transcripts(conversations)
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 == 0
    model = fit(lines.where(~held))
    each = rendered(parse(lines, model)).select("conv_id", "part", "turn", "n_lines", "n_right", F.sha2("canonical", 256).alias("sha"))
    in_order = F.array_sort(F.collect_list(F.struct("turn", "sha")))
    out = each.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n_turns"), F.sum("n_lines").alias("n_lines"), F.sum("n_right").alias("n_right"), F.sha2(F.array_join(F.transform(in_order, lambda x: x["sha"]), ""), 256).alias("canonical_sha256"))
    return out.select("conv_id", "n_turns", "n_lines", "n_right", F.coalesce(held, F.lit(False)).alias("held_out"), "canonical_sha256")
