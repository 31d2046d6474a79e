"""Freshness ledger: per target, when it was last fed and up to which business day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: what the targets are, and the suffix of the ledger key.
TARGET_TYPE = "hbase"


def feed_entries(targets: DataFrame, feed_time: Column, day: Column) -> DataFrame:
    """Ledger entries of one run for ``targets(name)``; day ``-1`` is a full-history run."""
    return targets.select(
        F.concat_ws("_", "name", F.lit(TARGET_TYPE)).alias("rowkey"), "name", F.lit(TARGET_TYPE).alias("type"),
        feed_time.cast("string").alias("feed_in_time"), day.cast("string").alias("last_data_time"),
        day.cast("string").alias("latest_data_time"))


def merge_ledger(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """Newest entry per target; ``latest_data_time`` only ever grows (``-1`` is the lowest)."""
    both = ledger.unionByName(entries)
    newest = F.max(F.struct("feed_in_time", "last_data_time", "name", "type")).alias("e")
    merged = both.groupBy("rowkey").agg(newest, F.max(F.col("latest_data_time").cast("int")).alias("latest"))
    return merged.select("rowkey", "e.name", "e.type", "e.feed_in_time", "e.last_data_time",
                         F.col("latest").cast("string").alias("latest_data_time"))
