"""Sessions of events per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def sessionize(df: DataFrame, user: str, ts: str, order: str, gap_seconds: int = 3600, given: Column | None = None,
               bucket_seconds: int = 60) -> DataFrame:
    """Add ``session_no`` (1, 2, … per user) and ``session_id``.

    A gap longer than ``gap_seconds`` starts a session, a gap of exactly that length does not.
    A row with a non-NULL ``given`` takes that id, and the rows after it stay in that session.
    Other ids are ``<user>_<session_no>``, so a re-run assigns the same ids. Rows without a time come
    first and are a session of their own; rows without a user are one more user.

    All users take the same way: events are spread over time buckets, and only a summary row of each
    bucket is ordered per user. With given ids, events are also ordered within their bucket of
    ``bucket_seconds``.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumns({"_us": us, "_given": (F.lit(None) if given is None else given).cast("string")})
    if given is None:
        return _by_time(rows, df.columns, user, gap_seconds)
    bucket = F.floor(us / F.lit(bucket_seconds * 1_000_000))
    return _with_given(rows.withColumn("_bucket", bucket), df.columns, user, order, gap_seconds)


def _by_time(rows: DataFrame, columns: list[str], user: str, gap_seconds: int) -> DataFrame:
    """Without given ids and with buckets no longer than the gap, a bucket lies within one session.

    So the session is found per bucket from its first and last time, which combine map-side, and
    the events only look it up: no event is sorted, and none is shuffled while the summary is small.
    """
    rows = rows.withColumn("_bucket", F.floor(F.col("_us") / F.lit(gap_seconds * 1_000_000)))
    buckets = rows.groupBy(F.col(user).alias("_u"), F.col("_bucket").alias("_b")).agg(
        F.min("_us").alias("_from"), F.max("_us").alias("_to"))
    per_user = W.partitionBy("_u").orderBy("_b")
    late = F.col("_from") - F.lag("_to").over(per_user) > F.lit(gap_seconds * 1_000_000)
    opened = buckets.withColumn("_opens", F.coalesce(late.cast("int"), F.lit(1)))
    numbered = opened.select("_u", "_b", F.sum("_opens").over(
        per_user.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("session_no"))
    out = rows.join(numbered, F.col(user).eqNullSafe(F.col("_u")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return out.select(*columns, "session_no", _own_id(user, F.col("session_no")).alias("session_id"))


def _own_id(user: str, session_no: Column) -> Column:
    return F.concat_ws("_", F.col(user).cast("string"), session_no.cast("string"))


def _with_given(rows: DataFrame, columns: list[str], user: str, order: str, gap_seconds: int) -> DataFrame:
    """Given ids can start a session anywhere in a bucket, so events are ordered within their bucket.

    What a bucket carries over from the ones before it is found on one summary row per bucket.
    """
    gap = F.lit(gap_seconds * 1_000_000)
    by_time = W.partitionBy(user, "_bucket").orderBy("_us", order)
    so_far = by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.row_number().over(by_time) == 1
    flagged = rows.withColumns({"_prev": F.lag("_us").over(by_time), "_first": first}).withColumn(
        # The first row of a bucket has no predecessor here; it is judged against the bucket before.
        "_start", F.when(F.col("_given").isNotNull(), 1)
                   .otherwise(F.coalesce(((F.col("_us") - F.col("_prev")) > gap).cast("int"), F.lit(0))))
    anchor = F.when(F.col("_start") == 1, F.struct(F.col("_us"), F.col(order).alias("_o"), F.col("_given").alias("g")))
    flagged = flagged.withColumn("_anchor", anchor)
    numbered = flagged.withColumns({
        "_local": F.sum("_start").over(so_far),
        "_local_anchor": F.last("_anchor", ignorenulls=True).over(so_far),
    })

    buckets = flagged.groupBy(F.col(user).alias("_u"), F.col("_bucket").alias("_b")).agg(
        F.min("_us").alias("_from"), F.max("_us").alias("_to"), F.sum("_start").alias("_starts"),
        F.max(F.col("_first") & F.col("_given").isNotNull()).alias("_given_first"),
        F.max("_anchor").alias("_last"))
    per_user = W.partitionBy("_u").orderBy("_b")
    prev_to = F.lag("_to").over(per_user)
    opens = F.when(F.col("_given_first"), 0).when(prev_to.isNull(), 1).otherwise(
        ((F.col("_from") - prev_to) > gap).cast("int"))
    opened = buckets.withColumn("_opens", opens)
    none_given = F.when(F.col("_opens") == 1, F.struct(F.lit(None).cast("string").alias("g")))
    tail = F.coalesce(F.when(F.col("_last").isNotNull(), F.struct(F.col("_last.g").alias("g"))), none_given)
    carried = opened.withColumn("_tail", tail).select(
        "_u", "_b",
        (F.sum(F.col("_starts") + F.col("_opens")).over(per_user.rowsBetween(W.unboundedPreceding, W.currentRow))
         - F.col("_starts")).alias("_before"),
        F.coalesce(none_given, F.last("_tail", ignorenulls=True).over(
            per_user.rowsBetween(W.unboundedPreceding, -1))).alias("_carried"))

    session_no = (F.col("_before") + F.col("_local")).cast("bigint")
    taken = F.when(F.col("_local_anchor").isNotNull(), F.col("_local_anchor.g")).otherwise(F.col("_carried.g"))
    out = numbered.join(carried, F.col(user).eqNullSafe(F.col("_u")) & F.col("_bucket").eqNullSafe(F.col("_b")))
    return out.select(*columns, session_no.alias("session_no"), F.coalesce(taken, _own_id(user, session_no)).alias("session_id"))


def session_stats(sessions: DataFrame, user: str, ts: str) -> DataFrame:
    """Start, end and size of each session."""
    return sessions.groupBy(user, "session_id").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n_events"))
