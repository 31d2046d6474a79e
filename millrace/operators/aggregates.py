"""Grouping helpers whose partial results combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def agg_pairs(df: DataFrame, keys: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Aggregates from ``(column, function)`` pairs; a repeated column keeps all its functions."""
    cols = [getattr(F, fn)(c).alias(f"{fn}_{c}") for c, fn in pairs]
    return df.groupBy(*keys).agg(*cols)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the smallest by ``order``, with the other columns as tie-break.

    A ``min`` over structs instead of a row number: no group is ever sorted or held as a whole.
    """
    rest = [c for c in df.columns if c not in keys]
    lead = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*lead, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def repeat_rows(df: DataFrame, times: str, chunk: int = 100_000, name: str | None = None) -> DataFrame:
    """Each row ``times`` times; ``name`` optionally numbers the copies from 1.

    Up to ``chunk`` copies are made in place. A row with more is first cut into chunks that are
    shuffled, so that billions of copies are written by many tasks and no task builds a long list.
    """
    cols = [c for c in df.columns if c != times]
    number = [F.col("_copy").alias(name)] if name else []
    one = F.lit(1).cast("bigint")

    few = df.where((F.col(times) > 0) & (F.col(times) <= chunk))
    few = few.select(*cols, F.explode(F.sequence(one, F.col(times))).alias("_copy")).select(*cols, *number)

    many = df.where(F.col(times) > chunk).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(times) - 1) / F.lit(chunk)))))
    last = F.least(F.col(times), (F.col("_chunk") + 1) * chunk)
    many = many.repartition(*cols, "_chunk").select(
        *cols, F.explode(F.sequence(F.col("_chunk") * chunk + 1, last)).alias("_copy")).select(*cols, *number)
    return few.union(many)


def number_duplicates(df: DataFrame, name: str = "copy_no") -> DataFrame:
    """Number identical rows 1, 2, 3 … from their count, without sorting or holding a group."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return repeat_rows(counted, "_n", name=name)


def _side_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both sides with their counts; columns are matched by position."""
    l = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)})
    r = right.toDF(*left.columns).withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    return l.union(r).groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))


def intersect_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of both sides, from one shuffle of distinct rows."""
    return _side_counts(left, right).where((F.col("_l") > 0) & (F.col("_r") > 0)).drop("_l", "_r")


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct left rows that the right side lacks, from one shuffle of distinct rows."""
    return _side_counts(left, right).where((F.col("_l") > 0) & (F.col("_r") == 0)).drop("_l", "_r")


def intersect_multiset(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows common to both, as often as in the side that has fewer copies."""
    both = _side_counts(left, right).withColumn("_n", F.least("_l", "_r")).drop("_l", "_r")
    return repeat_rows(both, "_n")


def except_multiset(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows minus one copy for each copy on the right."""
    rest = _side_counts(left, right).withColumn("_n", F.col("_l") - F.col("_r")).drop("_l", "_r")
    return repeat_rows(rest, "_n")
