"""Positions and running totals over rows in a global order, without a window over a whole table or key.

Rows are cut into blocks by ranges of the order and sorted inside each. What lies before a block is the sum of
the blocks before it, so a row needs its block's offset and its own place only. Equal rows can be in
different blocks: the range also cuts by the row's number, so a value that a third of all rows have is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.session import materialize

_LOCAL_BITS = 33  # of monotonically_increasing_id: the number of the row in its partition


def blocks_in_order(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """The rows as a written table with ``_block``, ascending in the order, and ``_place``, the number within it.

    NULLs are where the order puts them, first if nothing is said. Rows that tie are in any order among each other.
    """
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*order, F.col("_tie")]
    dealt = numbered.repartitionByRange(partitions, *keys) if partitions else numbered.repartitionByRange(*keys)
    number = F.monotonically_increasing_id()
    placed = dealt.sortWithinPartitions(*keys).select(*[F.col(f"`{c}`") for c in df.columns], number.alias("_number"))
    return materialize(placed.withColumn("_block", F.shiftright("_number", _LOCAL_BITS).cast("int"))
                       .withColumn("_place", F.col("_number").bitwiseAND((1 << _LOCAL_BITS) - 1)).drop("_number"), "in-order")


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position", partitions: int | None = None) -> DataFrame:
    """Every row with its place in the global order, from 1.

    Only one count per block comes to the driver, and goes back as a table of as many rows.
    """
    placed = blocks_in_order(df, order, partitions)
    spark, before, offsets = df.sparkSession, 0, []
    for block, n in sorted(placed.groupBy("_block").count().collect()):
        offsets.append((block, before))
        before += n
    found = placed.join(F.broadcast(spark.createDataFrame(offsets, "_block int, _before long")), "_block")
    return found.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_place") + 1).alias(name))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "total",
                   partitions: int | None = None) -> DataFrame:
    """Every row with the sum of ``value`` over the rows of its key up to and including it.

    A hot key is spread over many blocks. Totals of (key, block) are added up per key in a window over blocks, of which
    there are as many as partitions, and the rows of a block in a window over (key, block). A NULL value adds nothing;
    NULL keys are one key. Rows that tie in ``order`` are taken in any order.
    """
    placed = blocks_in_order(df, [*keys, *order], partitions)
    group = [F.col(f"`{k}`") for k in keys]
    total = F.coalesce(F.sum(value), F.lit(0))
    sums = placed.groupBy(*group, "_block").agg(total.alias("_sum"))
    earlier = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*[g.alias(f"_k{i}") for i, g in enumerate(group)], F.col("_block").alias("_b"),
                       F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    match = F.col("_block") == F.col("_b")
    for i, g in enumerate(group):
        match = match & g.eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*group, "_block").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    local = placed.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(sums, match).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_local")).alias(name))
