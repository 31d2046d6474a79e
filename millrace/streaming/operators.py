"""Event-time operators. Each is the same expression on a batch and on a stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def windowed_count(df: DataFrame, ts: str, key: str, length: str, slide: str | None = None) -> DataFrame:
    """Rows per (window, key) for sliding or, without ``slide``, tumbling windows."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    counted = df.groupBy(w.alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                          F.col("w.end").cast("timestamp_ntz").alias("window_end"), key, "n")


def running_count(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def words(df: DataFrame, text: str, *carried: str) -> DataFrame:
    """One row per blank-separated word, empty words included."""
    return df.select(*carried, F.explode(F.split(text, " ")).alias("word"))


def dedup_within(df: DataFrame, ts: str, delay: str, keys: list[str] | None = None) -> DataFrame:
    """First row per key (or per whole row). State is dropped once the watermark has passed."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys or df.columns)


def dedup_forever(df: DataFrame, ts: str, delay: str, keys: list[str] | None = None) -> DataFrame:
    """First row per key over the whole stream; without the event time in the key, state only grows."""
    return df.withWatermark(ts, delay).dropDuplicates(keys or df.columns)


def interval_stream_join(left: DataFrame, right: DataFrame, key: tuple[str, str], time_cols: tuple[str, str],
                         delays: tuple[str, str], seconds: int, how: str = "inner") -> DataFrame:
    """Equal keys and ``right_time <= left_time < right_time + seconds`` with a watermark on both sides.

    Both time bounds are in the condition, so Spark drops state that can no longer match. As in the
    batch form, rows also agree on a time slot as long as the interval, so the state and the
    comparisons of a hot key are spread over its slots.
    """
    (lk, rk), (lt, rt) = key, time_cols
    slot = lambda c: F.floor(F.unix_micros(F.col(c)) / F.lit(seconds * 1_000_000))
    ls = left.withWatermark(lt, delays[0]).withColumn("_slot", slot(lt))
    rs = right.withWatermark(rt, delays[1]).withColumn("_right_slot", F.explode(F.array(slot(rt), slot(rt) + 1)))
    cond: Column = ((F.col(lk) == F.col(rk)) & (F.col("_slot") == F.col("_right_slot")) & (F.col(lt) >= F.col(rt))
                    & (F.col(lt) < F.col(rt) + F.expr(f"INTERVAL {seconds} SECONDS")))
    return ls.join(rs, cond, how).drop("_slot", "_right_slot")


class RefreshingLookup:
    """A small side table that is read again inside ``foreachBatch`` once it is older than ``ttl`` seconds."""

    def __init__(self, load: Callable[[], DataFrame], ttl: float, clock: Callable[[], float] = time.monotonic):
        self.load, self.ttl, self.clock = load, ttl, clock
        self._frame: DataFrame | None = None
        self._read_at = 0.0

    def current(self) -> DataFrame:
        now = self.clock()
        if self._frame is None or now - self._read_at > self.ttl:
            self._frame, self._read_at = self.load(), now
        return self._frame
