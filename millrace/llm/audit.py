"""Filter interaction audit by contractions of a contingency tensor.

1. Every document gets one bit per filter: does it fail it? The bits are its cell in a tensor with one axis
   of two places, pass and fail, per filter.
2. Documents, good ones and toxic ones are counted per part and cell: at most ``2 ** filters`` rows per part.
3. One ``einsum`` multiplies each axis by the three selectors pass, fail and all. The result holds the count
   of every choice along every axis, and each step of each order of the filters is an index into it.

A hot part or text is one row per task and cell before anything is shuffled; the orders are never applied
to documents. Texts are read once and not shuffled; a digest stands for them in the search for copies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, same
from millrace.session import materialize

#: A word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Selectors along one axis, whose places are (pass, fail).
PASS, FAIL, ALL = 0, 1, 2
SELECTORS = np.array([[1, 0], [0, 1], [1, 1]], np.int64)

#: Parts that are contracted at a time.
PARTS = 256

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def is_short(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)) < 200


def is_repetitive(text: Column) -> Column:
    """Less than half of the words are different ones. A text without words is not repetitive."""
    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
               lambda w: F.size(F.array_distinct(w)).cast("long") * 100 < F.size(w).cast("long") * 50)


def is_loud(text: Column) -> Column:
    """More than 2 % of the code points are capitals A-Z."""
    chars = F.length(text).cast("long")
    return (chars - F.length(F.translate(text, CAPITALS, ""))) * 100 > chars * 2


def has_signs(text: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Filters that look at the text alone, by letter: what fails. A text of a smaller doc_id is filter E.
FILTERS: dict[str, Callable[[Column], Column]] = {"A": is_short, "B": is_repetitive, "C": is_loud, "D": has_signs}
COPY = "E"


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, Callable[[Column], Column]] | None = None,
             copy: str | None = COPY, part_col: str = "source") -> DataFrame:
    """Which filters each document fails: ``(doc_id, part, good, toxic, cell)`` rows, one per row of ``docs``.

    ``cell`` has one bit per filter in their order, the first the highest, ``copy`` the last. A null text is empty;
    a null part is the empty one. A document fails ``copy`` if a smaller doc_id has the same text, so rows that
    repeat both pass or fail together; a row without an id passes, and makes no other fail. A document is good or
    toxic if any of its labels says so; labels without an id belong to none.
    """
    filters = FILTERS if filters is None else filters
    text = F.coalesce("text", F.lit(""))
    cell = sum((fn(text).cast("int") * (1 << i) for i, fn in enumerate(reversed(filters.values()))), F.lit(0))
    rows = docs.select("doc_id", F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), cell.alias("cell"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.join(marks, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "part", "cell", "digest", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    if not copy:
        return rows.drop("digest")
    rows = materialize(rows, "audit")
    # The key of the join is digest and id, so that a hot text is dealt out by its ids.
    first = rows.where("doc_id IS NOT NULL").groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_first"))
    later = F.col("_digest").isNull() & F.col("doc_id").isNotNull()
    return rows.join(first, same(F.col("digest"), F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left").select(
        "doc_id", "part", "good", "toxic", (F.col("cell") * 2 + later.cast("int")).alias("cell"))


def steps_of(letters: str) -> list[tuple[str, int, int]]:
    """Every step of every order: ``(order, step from 0, axis of its filter)``."""
    return [("".join(order), i, letters.index(f)) for order in permutations(letters) for i, f in enumerate(order)]


def selection(letters: str, choose: Callable[[str, int, int, str], int]) -> np.ndarray:
    """Places of the steps in the contracted tensor; ``choose`` gives the selector of a letter's axis."""
    return np.array([np.ravel_multi_index([choose(order, i, axis, f) for f in letters], [3] * len(letters))
                     for order, i, axis in steps_of(letters)])


def contract(tensors: np.ndarray) -> np.ndarray:
    """Counts of every choice of selectors: ``(..., 2, ..., 2)`` after two leading axes becomes ``(part, kind, 3 ** axes)``."""
    axes = tensors.ndim - 2
    lower, upper = "abcdefghij"[:axes], "ABCDEFGHIJ"[:axes]
    spec = f"yz{lower},{','.join(u + v for u, v in zip(upper, lower))}->yz{upper}"
    out = np.einsum(spec, tensors, *[SELECTORS] * axes, optimize=True)
    return out.reshape(*out.shape[:2], 3 ** axes)


def audit(cells: DataFrame, letters: str = "".join(FILTERS) + COPY) -> DataFrame:
    """All orders of the filters over :func:`failures`: one row per part, order and step.

    Columns are ``part, filter_order, step`` and the long counts of :data:`COUNTS`. Removed documents fail the step's
    filter and pass all before it; redundant ones fail it but went earlier; unique ones fail no other. ``shapley`` is
    the filter's sum of removed documents over all orders. A table without rows has no parts and gives no rows.
    """
    k = len(letters)
    counted = cells.groupBy("part", "cell").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic"))
    # At most 2 ** k rows of a part come together here.
    tensors = counted.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = steps_of(letters)
        kept = selection(letters, lambda o, i, axis, f: PASS if o.index(f) <= i else ALL)
        removed = selection(letters, lambda o, i, axis, f: FAIL if f == o[i] else PASS if o.index(f) < i else ALL)
        failing = selection(letters, lambda o, i, axis, f: FAIL if f == o[i] else ALL)
        alone = selection(letters, lambda o, i, axis, f: FAIL if f == o[i] else PASS)
        axis_of = np.array([axis for *_, axis in steps])
        owns = np.eye(k, dtype=np.int64)[axis_of]
        orders, places = pa.array([o for o, *_ in steps]), np.array([i + 1 for _, i, _ in steps], np.int32)
        for whole in batches:
            for start in range(0, whole.num_rows, PARTS):
                batch = whole.slice(start, PARTS)
                tensor = np.zeros((batch.num_rows, 3, 2 ** k), np.int64)
                for p, rows in enumerate(batch.column("cells").to_pylist()):
                    for r in rows:
                        tensor[p, :, r["cell"]] = r["n"], r["good"], r["toxic"]
                picked = contract(tensor.reshape(batch.num_rows, 3, *[2] * k))
                n_removed = picked[:, 0, removed]
                counts = (picked[:, 0, kept], n_removed, picked[:, 0, failing] - n_removed, picked[:, 0, alone],
                          picked[:, 1, removed], picked[:, 2, removed], (n_removed @ owns)[:, axis_of])
                part = np.repeat(np.arange(batch.num_rows), len(steps))
                step = np.tile(np.arange(len(steps)), batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part").take(pa.array(part)), orders.take(pa.array(step)), pa.array(places[step]),
                     *[pa.array(c.reshape(-1)) for c in counts]], names=["part", "filter_order", "step", *COUNTS])

    return tensors.mapInArrow(run, f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in COUNTS)}")
