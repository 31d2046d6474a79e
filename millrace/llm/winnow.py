"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Of every ``w`` consecutive k-gram hashes the smallest is kept, in documents and benchmark items alike,
with ``k + w - 1 = 13``: a shared span of 13 words has a common run of ``w`` k-grams, so both sides keep
the same smallest one and the join on it finds every such span. Each hit gives an alignment of document
and item, which is extended over the whole item by comparing words; only windows equal word by word count.

An item of fewer than 13 words is one window of its own length n, which is found by k = n and w = 1.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut_lineage, let, narrow, same
from millrace.session import materialize

WINDOW, GRAM = 13, 7
#: What words consist of none of, and a word.
GAP, WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Low bits of a packed k-gram that hold its place; a string has fewer words than that.
PLACE_BITS = 30


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased and nothing else."""
    def lowered(w: Column) -> Column:
        plain = F.translate(w, string.ascii_uppercase, string.ascii_lowercase)
        return F.when(F.octet_length(w) == F.length(w), F.lower(w)).when(w.rlike("[A-Z]"), plain).otherwise(w)

    return F.transform(F.array_remove(F.split(text, GAP), ""), lowered)


def kept_grams(hashes: Column, k: int, w: int) -> Column:
    """Winnowed k-grams of an array of word hashes: hash in the high bits, first word's place in the low ones.

    Fewer than ``k + w - 1`` words have no such span and give nothing.
    """
    high = F.lit(-(1 << PLACE_BITS)).cast("long")

    def gram(h: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(h, i + j) for j in range(k)]).bitwiseAND(high).bitwiseOR(i.cast("long"))

    def winnowed(grams: Column) -> Column:
        if w == 1:
            return grams
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(grams) - w + 1),
                                            lambda i: F.array_min(F.slice(grams, i, w))))

    def of(h: Column) -> Column:
        all_grams = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: gram(h, i))
        return F.when(F.size(h) >= k + w - 1, let(all_grams, winnowed))

    return let(hashes, of)


def _prints(df: DataFrame, keys: list[str], k: int, w: int) -> DataFrame:
    """Exploded fingerprints ``(keys, print, place)`` of a frame with a column ``hashes``."""
    low = (1 << PLACE_BITS) - 1
    return df.select(*keys, F.explode(kept_grams(F.col("hashes"), k, w)).alias("g")).select(
        *keys, F.shiftright("g", PLACE_BITS).alias("print"), F.col("g").bitwiseAND(F.lit(low)).cast("int").alias("place"))


def _shapes(items: DataFrame) -> list[tuple[int, int, int]]:
    """``(window, k, w)`` for each window length of the items; there are 13 at most."""
    lengths = items.select(F.least("n", F.lit(WINDOW)).alias("n")).where("n > 0").distinct().collect()
    return sorted((r.n, GRAM, WINDOW - GRAM + 1) if r.n == WINDOW else (r.n, r.n, 1) for r in lengths)


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, th, item_id, ih, win, shift)``: item word j may equal document word j + shift."""
    hashed = F.transform("words", lambda x: F.xxhash64(x))
    docs = docs.select("doc_id", "th", words(F.col("text")).alias("words")).select("doc_id", "th", hashed.alias("hashes"))
    found = None
    for win, k, w in _shapes(items):
        of_items = items.where(F.least("n", F.lit(WINDOW)) == win).select("item_id", "ih", hashed.alias("hashes"))
        # Written, so that Spark knows its size: it is broadcast only if small, and shuffled with the rest if not.
        of_items = materialize(_prints(of_items, ["item_id", "ih"], k, w).withColumnRenamed("place", "at"), "item-prints")
        hits = _prints(docs, ["doc_id", "th"], k, w).join(of_items, "print").select(
            "doc_id", "th", "item_id", "ih", F.lit(win).alias("win"), (F.col("place") - F.col("at")).alias("shift"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.crossJoin(items.select("item_id", "ih").limit(0)).select(
            "doc_id", "th", "item_id", "ih", F.lit(0).alias("win"), F.lit(0).alias("shift"))
    return found.distinct()


def contamination(df: DataFrame, benchmark: DataFrame, least: int = 20) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A document word inside any occurrence of an item's window is hit; it is contaminated if a word is
    hit and the hit words are at least one in ``least``. A null text has no words and an item without
    words no window. A null item id counts as an empty one. Rows with equal id and text get equal
    results; other columns are ignored. An empty benchmark hits nothing.
    """
    return _judged(narrow(df), benchmark, least).drop("th")


def _judged(docs: DataFrame, benchmark: DataFrame, least: int) -> DataFrame:
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    items = narrow(benchmark, "item_id").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("item_id"), F.xxhash64("text").alias("ih"),
        words(F.col("text")).alias("words")).withColumn("n", F.size("words")).distinct()
    found = cut_lineage(alignments(docs, items))
    # Each document is cut up once: a slice per alignment, as long as the longest item aligned there.
    sizes = items.select("item_id", "ih", "n")
    needed = found.join(sizes, ["item_id", "ih"]).groupBy("doc_id", "th", "shift").agg(F.max("n").alias("n"))
    needed = needed.groupBy("doc_id", "th").agg(F.collect_list(F.struct("shift", "n")).alias("cuts"))
    key = lambda a, b: same(a["doc_id"], b["doc_id"]) & (a["th"] == b["th"])
    cut = docs.join(needed, key(docs, needed)).select(docs["doc_id"], docs["th"], words(F.col("text")).alias("words"), "cuts")
    cut = cut.dropDuplicates(["doc_id", "th"]).select("doc_id", "th", "words", F.explode("cuts").alias("c")).select(
        "doc_id", "th", F.col("c.shift").alias("shift"), F.slice(
            "words", F.greatest("c.shift", F.lit(0)) + 1, F.col("c.n") + F.least("c.shift", F.lit(0))).alias("part"))
    pairs = found.join(cut, key(found, cut) & (found["shift"] == cut["shift"])).select(
        found["doc_id"], found["th"], "item_id", "ih", "win", found["shift"], "part").join(items, ["item_id", "ih"])
    equal = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.coalesce(
        F.get(F.col("part"), j + F.least("shift", F.lit(0))) == F.get(F.col("words"), j), F.lit(False)))
    starts = let(equal, lambda eq: F.filter(F.sequence(F.lit(0), F.col("n") - F.col("win")),
                                            lambda s: F.forall(F.slice(eq, s + 1, F.col("win")), lambda e: e)))
    pairs = pairs.select("doc_id", "th", "item_id", "win", "shift", F.explode(starts).alias("s"))
    spans = pairs.select("doc_id", "th", "item_id", "win", (F.col("s") + F.col("shift")).alias("at"))
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda x: F.sequence(x["at"], x["at"] + x["win"] - 1))))
    hit = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("at", "win")).alias("spans"),
                                            F.array_sort(F.collect_set("item_id")).alias("ids"))
    hit = cut_lineage(hit.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"),
                                 F.size(covered).cast("long").alias("n_hit"), F.size("ids").cast("long").alias("n_items"),
                                 F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))
    counted = docs.select("doc_id", "th", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"))
    joined = counted.join(hit, same(F.col("doc_id"), F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select("doc_id", "th", "n_words", n_hit.alias("n_hit"),
                         F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                         F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                         ((n_hit > 0) & (least * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, least: int = 20) -> DataFrame:
    """The rows of ``df`` that :func:`contamination` does not call contaminated."""
    bad = _judged(narrow(df), benchmark, least).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct()
    text = F.coalesce(df["text"], F.lit(""))
    return df.join(bad, same(df["doc_id"], bad["_id"]) & (F.xxhash64(text) == bad["_th"]), "left_anti")
