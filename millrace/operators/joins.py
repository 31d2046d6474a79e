"""Joins beyond a plain ``DataFrame.join``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Rows that a side may be declared to have at most, if nothing else is said.
LOOKUP_ROWS = 200_000


def lookup(df: DataFrame, max_rows: int = LOOKUP_ROWS) -> DataFrame:
    """A side declared to have at most ``max_rows`` rows, to be broadcast.

    The bound is held while the join runs: beyond it the query fails and loses no row. Nothing runs
    while the plan is built, and the count reads ``max_rows + 1`` rows at most. For a side without a
    bound, write a plain join: Spark then decides by file sizes and at run time.
    """
    few = df.limit(max_rows + 1).withColumn("_rows", F.count(F.lit(1)).over(W.partitionBy(F.lit(0))))
    too_many = F.raise_error(F.lit(f"more than the declared {max_rows} rows"))
    return F.broadcast(few.where(F.when(F.col("_rows") > max_rows, too_many.cast("boolean")).otherwise(True)).drop("_rows"))


def join_pairs(left: DataFrame, right: DataFrame, condition: Column, how: str = "left", max_right: int = LOOKUP_ROWS) -> DataFrame:
    """Both rows as structs ``l`` and ``r``, an unmatched side as a NULL struct.

    Any condition is allowed, so every pair is looked at: the right side must be a :func:`lookup`.
    """
    # Structs are built before the join, so that an unmatched side is one NULL and not a struct of NULLs.
    ls = left.select(F.struct("*").alias("l"))
    rs = lookup(right.select(F.struct("*").alias("r")), max_right)
    return ls.join(rs, condition, how)


def join_trimmed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on text keys of which one side may be blank-padded."""
    strip = {k: F.rtrim(F.col(k)) for k in on}
    return left.withColumns(strip).join(right.withColumns(strip), list(on), how)


def keep_matching(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows whose key occurs on the right (left semi-join).

    The right side is reduced to its distinct keys first: repeats combine map-side, where a plain
    semi-join would send all rows of a hot key to one task, which AQE cannot split on this side.
    The join reuses the partitioning of the reduction.
    """
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def drop_matching(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left rows whose key does not occur on the right (left anti-join), reduced in the same way."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def semi_with_difference(left: DataFrame, right: DataFrame, key: str, differs: str) -> DataFrame:
    """Left rows whose key occurs on the right with another value of ``differs``.

    Two distinct values per key decide it, so the right side is reduced to its smallest and
    largest value per key before the join; no pairs are formed.
    """
    span = right.groupBy(key).agg(F.min(differs).alias("_lo"), F.max(differs).alias("_hi"))
    differing = (F.col("_lo") != F.col(differs)) | (F.col("_hi") != F.col(differs))
    return left.join(span, key).where(differing).select(*left.columns)


def interval_join(left: DataFrame, right: DataFrame, key: tuple[str, str], time: tuple[str, str],
                  seconds: int, how: str = "inner") -> DataFrame:
    """Equal keys and ``right_time <= left_time < right_time + seconds``.

    Time is cut into slots as long as the interval: a right row can only match left rows of its
    own slot and the next, so the equi-join runs on (key, slot). A hot key thus spreads over its
    slots, and rows far apart in time never meet. Every left row is in one slot, so outer rows
    and pairs come out once.
    """
    (lk, rk), (lt, rt) = key, time
    slot = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / F.lit(seconds * 1_000_000))
    ls = left.withColumn("_slot", slot(lt))
    rs = right.withColumn("_right_slot", F.explode(F.array(slot(rt), slot(rt) + 1)))
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    cond = ((F.col(lk) == F.col(rk)) & (F.col("_slot") == F.col("_right_slot"))
            & (F.col(lt) >= F.col(rt)) & (F.col(lt) < F.col(rt) + span))
    return ls.join(rs, cond, how).drop("_slot", "_right_slot")


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int = 16, how: str = "inner",
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Equi-join for hot keys on the left: each left key is spread over ``salts`` tasks and the
    right row is repeated for each of them. Only inner, left, left_semi and left_anti keep their
    meaning under repetition of the right side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting the left side does not support {how!r}")
    salt = F.pmod(F.xxhash64(*(spread_by or left.columns)), F.lit(salts)).cast("int")
    ls = left.withColumn("_salt", salt)
    rs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return ls.join(rs, [*on, "_salt"], how).drop("_salt")
