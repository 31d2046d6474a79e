"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts is its place
in a grid. Counts differ in total by at most the number of differing bits (Manhattan distance is a
lower bound of Hamming distance), so within two bits at most two counts differ, each segment lying in
one of five blocks, and at least three blocks of counts are equal. Ten projections of the grid, one per
three blocks, therefore hold every link in a common cell. Pairs of a cell are kept if their Manhattan
distance allows it and then verified bit by bit.

A cell with many fingerprints is not paired. Its members instead name the 65 fingerprints within one
bit of their own: two are within two bits exactly if they name a common one, and all who name one are
within two bits of each other, at most 65 of them. Each is linked to the smallest, which loses no
connection and costs 65 rows per member, however dense the cell.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, cut_lineage, map_texts, narrow, same

SHINGLE, BITS = 3, 2
#: Bit ranges of the five blocks of segments.
BLOCKS = ((0, 14), (14, 14), (28, 12), (40, 12), (52, 12))
#: Beyond so many members, a cell is linked by common neighbours and not by pairs.
DENSE = 64


def fingerprint(text: str) -> int:
    """SimHash of the three-word shingles; see :func:`fingerprints`."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    counts, n = np.zeros(64, np.int64), 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    for at in range(0, len(hashes), 4096):  # keeps the bit matrix small for very long texts
        part = hashes[at:at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame) -> DataFrame:
    """``(doc_id, fp)``: the SimHash of every whole text as a signed 64-bit number.

    A-Z are lower-cased, words are separated by ASCII white space, shingles are three words joined by
    a space, with repeats; a shorter text is one shingle and one without words has fingerprint zero.
    A bit is set if it is in over half of the shingles' XXH64 (UTF-8, seed 42).
    """
    return map_texts(narrow(df), lambda: lambda texts: [[fingerprint(t) for t in texts]], "fp long", ["fp"], [pa.int64()])


def _and(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask if mask < 1 << 63 else mask - (1 << 64)))


def segment_counts(fp: Column) -> Column:
    """Bit counts (0 to 2) of the 32 two-bit segments, packed into one number."""
    ones = 0x5555555555555555
    low, high = _and(fp, ones), _and(F.shiftrightunsigned(fp, 1), ones)
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(x: Column, y: Column) -> Column:
    """Sum of the differences of two packed vectors of counts."""
    at = lambda v, i: F.shiftrightunsigned(v, 2 * i).bitwiseAND(F.lit(3))
    return reduce(lambda s, i: s + F.abs(at(x, i) - at(y, i)), range(1, 32), F.abs(at(x, 0) - at(y, 0)))


def hamming(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def links(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints ``fp``: every two within two bits are connected by them."""
    placed = prints.select("fp", segment_counts(F.col("fp")).alias("v"))
    cells = [F.struct(F.lit(i).alias("grid"), _and(F.col("v"), sum(((1 << w) - 1) << s for s, w in three)).alias("cell"))
             for i, three in enumerate(combinations(BLOCKS, 3))]
    placed = placed.select("fp", "v", F.explode(F.array(*cells)).alias("c")).select("fp", "v", "c.grid", "c.cell")
    shared = cut_lineage(placed.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1"))
    members = cut_lineage(placed.join(shared, ["grid", "cell"]))
    few = members.where(F.col("n") <= dense)
    x = few.select("grid", "cell", F.col("fp").alias("a"), F.col("v").alias("va"))
    y = few.select("grid", "cell", F.col("fp").alias("b"), F.col("v").alias("vb"))
    near = x.join(y, ["grid", "cell"]).where(F.col("a") < F.col("b"))
    near = near.where(manhattan(F.col("va"), F.col("vb")) <= BITS).where(hamming(F.col("a"), F.col("b")) <= BITS)
    many = cut_lineage(members.where(F.col("n") > dense).select("fp").distinct())
    flips = [0] + [1 << i for i in range(63)] + [-(1 << 63)]
    named = many.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in flips])).alias("mid"))
    common = named.groupBy("mid").agg(F.array_sort(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    stars = common.select(F.col("fps")[0].alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return near.select("a", "b").unionByName(stars).distinct()


def near_groups(df: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Documents whose fingerprints differ in two bits or fewer are linked; ``component_id`` is the
    smallest doc_id reachable. Texts that are null or without words all have fingerprint zero and are
    linked like any other. Null ids are ignored when the smallest is taken; it is null if there is no
    other. Repeated rows are repeated in the result; other columns are ignored.
    """
    prints = cut_lineage(fingerprints(df))
    # One row per fingerprint from here on: copies are not paired.
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct))
    named = cut_lineage(distinct.join(roots, F.col("fp") == F.col("node"), "left")
                        .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = cut_lineage(named.join(least, "root").select(F.col("fp").alias("_fp"), "component_id"))
    return prints.join(by_print, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near(df: DataFrame) -> DataFrame:
    """The input with one document of each group: the one with the smallest doc_id.

    Rows that repeat an id stay or go together; a row without id stays, since nothing names it.
    """
    groups = near_groups(df).where(~same(F.col("doc_id"), F.col("component_id"))).select(F.col("doc_id").alias("_id"))
    groups = groups.distinct()
    return df.join(groups, df["doc_id"] == groups["_id"], "left_anti")
