"""Personal data: fixed patterns, and spans that boosted trees add, in DataFrame functions alone.

The base patterns give spans of four kinds. High-recall generators propose further, overlapping spans, each
with small whole-number features of its format and of what stands around it. A candidate inside a base span
of its kind is a positive example and any other a negative one, but for parts of a match of a base pattern that
does not count, such as two numbers that run into each other; counts of equal feature rows over the whole
table, a table of bounded size, are all that the trees are grown from. Per kind, the lowest score from which
on enough of the examples are positive is the threshold, so what reads like personal data and escapes
the base patterns, such as a number that runs into the next one, is added. Base spans always stay, and of
overlapping candidates the longest is taken.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import let, narrow
from millrace.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that no start inside a run that failed is tried again.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Candidate patterns and the kind each proposes.
GENERATORS = (
    ("card", r"(?<![0-9])[0-9]{14,19}(?![0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|(?:[0-9]{4}[ -]){3}[0-9]{2,7})(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]{1,63}"
              r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"),
)
#: Words before a span that speak of personal data.
CUES = r"(?i)(?:tel|phone|call|fax|mobile|card|visa|credit|e-?mail|contact|host|addr)[a-z]*[^A-Za-z0-9]{0,4}$"
FEATURES = ("gen", "digits", "luhn", "plus", "paren", "seps", "prev", "next", "cue")
ROUNDS, DEPTH, RATE, RIDGE, PRECISION = 30, 3, 0.3, 1.0, 0.8

CHUNK = 200
_SPAN = "array<struct<start:int,end:int,s:string,before:string,after:string>>"


def running(sizes: Column) -> Column:
    """For each element of an array, the sum of those before it.

    Summed in chunks, then over the chunks, as growing one long array element by element is quadratic.
    """
    def sums(part: Column) -> Column:
        return F.aggregate(part, F.array(F.lit(0)), lambda seen, x: F.array_append(seen, F.element_at(seen, -1) + x))

    def joined(chunks: Column) -> Column:
        totals = sums(F.transform(chunks, lambda c: F.element_at(c, -1)))
        return let(totals, lambda t: F.flatten(F.transform(chunks, lambda c, i: F.transform(
            F.slice(c, 1, F.size(c) - 1), lambda x: x + F.get(t, i)))))

    starts = F.sequence(F.lit(1), F.size(sizes), F.lit(CHUNK))
    return let(F.transform(starts, lambda at: sums(F.slice(sizes, at, CHUNK))), joined)


def occurrences(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their code-point spans and a few characters before and after."""
    def spans(found: Column, gaps: Column, at: Column) -> Column:
        def one(s: Column, k: Column) -> Column:
            start = F.get(at, k) + F.length(F.get(gaps, k))
            return F.struct(start.alias("start"), (start + F.length(s)).alias("end"), s.alias("s"),
                            F.right(F.get(gaps, k), F.lit(20)).alias("before"), F.left(F.get(gaps, k + 1), F.lit(1)).alias("after"))

        return F.transform(found, one)

    def placed(found: Column, gaps: Column) -> Column:
        sizes = F.transform(found, lambda s, k: F.length(F.get(gaps, k)) + F.length(s))
        return let(let(sizes, running), lambda at: spans(found, gaps, at))

    none = F.array().cast(_SPAN)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(
        F.size(found) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps)).cast(_SPAN)).otherwise(none))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def valid(kind: str, s: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "ip":
        return s.rlike(rf"^{PART}\.{PART}\.{PART}\.{PART}$")
    if kind == "card":
        return F.length(digits(s)).between(14, 19) & F.call_function("luhn_check", digits(s))
    if kind == "phone":
        return F.length(digits(s)).between(10, 15)
    return F.lit(True)


def base_matches(text: Column) -> Column:
    """All matches of base patterns as an array of ``(start, kind, end, ok)``, kinds numbered as listed."""
    def of(i: int, kind: str) -> Column:
        return F.transform(occurrences(text, BASE[kind]), lambda x: F.struct(
            x["start"].alias("start"), F.lit(i).alias("kind"), x["end"].alias("end"), valid(kind, x["s"]).alias("ok")))

    return F.array_sort(F.concat(*(of(i, k) for i, k in enumerate(KINDS))))


def _beside(c: Column) -> Column:
    """Class of a neighbouring character: none or another match, letter, digit, space, other."""
    return F.when(c == "", 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"\s"), 3).otherwise(4)


def candidates(text: Column) -> Column:
    """Proposed spans as an array of ``(start, kind, end)`` and features."""
    def features(g: int, kind: str, x: Column) -> Column:
        s, number = x["s"], digits(x["s"])
        flag = lambda c: F.when(c, 1).otherwise(0)
        return F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), F.lit(g).alias("gen"),
            F.least(F.length(number), F.lit(20)).alias("digits"), flag(F.call_function("luhn_check", number)).alias("luhn"),
            flag(s.startswith("+")).alias("plus"), flag(s.contains("(")).alias("paren"),
            F.least(F.length(s) - F.length(F.regexp_replace(s, "[ .-]", "")), F.lit(4)).alias("seps"),
            _beside(F.right(x["before"], F.lit(1))).alias("prev"), _beside(x["after"]).alias("next"),
            flag(x["before"].rlike(CUES)).alias("cue"))

    def proposed(g: int, kind: str, pattern: str) -> Column:
        return F.transform(occurrences(text, pattern), lambda x: features(g, kind, x))

    return F.concat(*(proposed(g, kind, pattern) for g, (kind, pattern) in enumerate(GENERATORS)))


class Boosted:
    """Boosted trees over counted feature rows: ``x`` whole numbers, ``y`` positives of ``n`` examples."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.start = float(np.log((y.sum() + 1) / (n.sum() - y.sum() + 1)))
        self.trees, f = [], np.full(len(x), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(x, y - n * p, n * p * (1 - p), np.arange(len(x)), DEPTH)
            self.trees.append(tree)
            f = f + np.array([self._leaf(tree, row) for row in x])
        self.scores = 1 / (1 + np.exp(-f))

    def _grow(self, x, slope, curve, rows, depth):
        g, h = slope[rows].sum(), curve[rows].sum()
        best, cut = 1e-6, None
        for j in range(x.shape[1] if depth else 0):
            for value in np.unique(x[rows, j])[:-1]:
                low = rows[x[rows, j] <= value]
                a, b = slope[low].sum(), curve[low].sum()
                gain = a * a / (b + RIDGE) + (g - a) ** 2 / (h - b + RIDGE) - g * g / (h + RIDGE)
                if gain > best:
                    best, cut = gain, (j, int(value))
        if cut is None:
            return float(RATE * g / (h + RIDGE))
        left = x[rows, cut[0]] <= cut[1]
        return (*cut, self._grow(x, slope, curve, rows[left], depth - 1), self._grow(x, slope, curve, rows[~left], depth - 1))

    @staticmethod
    def _leaf(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    def column(self, of: Column) -> Column:
        """The probability as an expression over a struct of features."""
        def expr(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            return F.when(of[FEATURES[tree[0]]] <= tree[1], expr(tree[2])).otherwise(expr(tree[3]))

        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, map(expr, self.trees), F.lit(self.start))))


def fit(found: DataFrame) -> tuple[Boosted, list[float]] | None:
    """Trees and a threshold per kind from ``matches`` and ``cands``; nothing without positive examples.

    Counts of distinct feature rows come to the driver; the features' ranges bound their number.
    """
    # Matches of a kind do not overlap, so only the last one that begins before a candidate can hold it.
    nothing = F.lit(None)
    cands = found.select("_d", F.explode("cands").alias("c")).select(
        "_d", F.col("c.kind").alias("kind"), F.col("c.start").alias("at"), F.lit(1).alias("late"), "c")
    matches = found.select("_d", F.explode("matches").alias("m")).select(
        "_d", F.col("m.kind").alias("kind"), F.col("m.start").alias("at"), F.lit(0).alias("late"), "m")
    both = cands.withColumn("m", nothing.cast(matches.schema["m"].dataType)).unionByName(
        matches.withColumn("c", nothing.cast(cands.schema["c"].dataType)))
    before = Window.partitionBy("_d", "kind").orderBy("at", "late").rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("m", F.last("m", ignorenulls=True).over(before)).where("c IS NOT NULL")
    over = F.coalesce(F.col("m.end") >= F.col("c.end"), F.lit(False))
    # A part of a match that does not count may well be personal data: it is no example of either.
    unknown = over & ~F.col("m.ok") & (F.col("m.end") - F.col("m.start") > F.col("c.end") - F.col("c.start"))
    rows = placed.withColumn("y", F.when(over & F.col("m.ok"), 1).when(~unknown, 0)).where("y IS NOT NULL")
    rows = rows.select("kind", *(F.col(f"c.{f}").alias(f) for f in FEATURES), "y")
    counted = rows.groupBy("kind", *FEATURES).agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()
    x = np.array([[r[f] for f in FEATURES] for r in counted], np.int64)
    y, n = np.array([r.y for r in counted], float), np.array([r.n for r in counted], float)
    if not y.sum():
        return None
    model, cuts = Boosted(x, y, n), []
    for k in range(len(KINDS)):
        own = np.array([r.kind == k for r in counted])
        order = np.flatnonzero(own)[np.argsort(-model.scores[own], kind="stable")]
        share = np.cumsum(y[order]) / np.cumsum(n[order])
        good = np.flatnonzero((share >= PRECISION) & (model.scores[order] >= 0.5))
        cuts.append(float(model.scores[order[good[-1]]]) - 1e-9 if len(good) else 2.0)
    return model, cuts


def _longest_apart(found: DataFrame, triple: str) -> DataFrame:
    """``_d, added``: of the candidates that touch no base span, the longest ones that do not overlap each other.

    Spans are compared in the order of their place: a candidate overlaps a base span if one that begins before its end
    ends after its start, and candidates are cut into runs of overlapping ones, within which the longest go first.
    """
    order = Window.partitionBy("_d").orderBy("at", "late").rowsBetween(Window.unboundedPreceding, 0)
    cands = found.select("_d", F.explode("passed").alias("c")).select(
        "_d", F.col("c.end").alias("at"), F.lit(0).alias("late"), F.lit(None).cast("int").alias("base_end"),
        F.struct("c.start", "c.kind", "c.end").alias("c"))
    base = found.where(F.size("passed") > 0).select("_d", F.explode("base").alias("b")).select(
        "_d", F.col("b.start").alias("at"), F.lit(1).alias("late"), F.col("b.end").alias("base_end"),
        F.lit(None).cast(cands.schema["c"].dataType).alias("c"))
    free = cands.unionByName(base).withColumn("reach", F.max("base_end").over(order)).where(
        F.col("c").isNotNull() & (F.coalesce("reach", F.lit(0)) <= F.col("c.start"))).select("_d", "c.*")
    by_start = Window.partitionBy("_d").orderBy("start", "end", "kind")
    ended = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    runs = free.withColumn("fresh", F.coalesce((F.col("start") >= ended).cast("int"), F.lit(1))).withColumn(
        "run", F.sum("fresh").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    longest = F.array_sort(F.collect_list(F.struct((F.col("start") - F.col("end")).alias("size"), "start", "kind", "end")))
    runs = runs.groupBy("_d", "run").agg(longest.alias("longest"))
    apart = lambda seen, c: ~F.exists(seen, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    taken = F.aggregate("longest", F.array().cast(triple), lambda seen, c: F.when(
        apart(seen, c), F.array_append(seen, F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))).otherwise(seen))
    return runs.select("_d", taken.alias("taken")).groupBy("_d").agg(F.flatten(F.collect_list("taken")).alias("added"))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, KINDS)), x["kind"]), x["start"], x["end"])), ",")


def personal_spans(df: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``.

    The counts and the digest are of the base spans; ``spans`` lists all, as ``kind:start:end`` in code
    points by start and then kind. A null text counts as empty, and a text without spans has an empty
    list. Rows are independent of each other but for the trees; other columns are ignored.
    """
    text = F.col("text")
    found = materialize(narrow(df).select(F.monotonically_increasing_id().alias("_d"), "doc_id", base_matches(text).alias("matches"), candidates(text).alias("cands")), "candidates")
    model = fit(found)
    triple = "array<struct<start:int,kind:int,end:int>>"
    base = F.transform(F.filter("matches", lambda b: b["ok"]), lambda b: F.struct(b["start"], b["kind"], b["end"]))
    found = found.select("_d", "doc_id", "cands", base.cast(triple).alias("base"))
    if model:
        trees, cuts = model
        passed = F.filter("cands", lambda c: trees.column(c) >= F.get(F.array(*map(F.lit, cuts)), c["kind"]))
        found = found.join(_longest_apart(found.select("_d", passed.alias("passed"), "base"), triple), "_d", "left")
    else:
        found = found.withColumn("added", F.lit(None).cast(triple))
    added = F.coalesce("added", F.array().cast(triple))
    count_of = lambda i: F.size(F.filter("base", lambda b: b["kind"] == i)).cast("long")
    counts = [count_of(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    out = found.select("doc_id", "base", *counts, added.alias("added"))
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
                      _text_of(F.array_sort(F.concat("base", "added"))).alias("spans"),
                      F.size("added").cast("long").alias("n_added"))


def redact(df: DataFrame) -> DataFrame:
    """Every document's spans as rows ``doc_id, kind, start, end``."""
    one = personal_spans(df).where("spans <> ''").select("doc_id", F.explode(F.split("spans", ",")).alias("span"))
    return one.select("doc_id", F.split("span", ":").alias("x")).select(
        "doc_id", F.col("x")[0].alias("kind"), F.col("x")[1].cast("int").alias("start"), F.col("x")[2].cast("int").alias("end"))
