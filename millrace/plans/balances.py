"""Account balances: a seed of one day plus signed changes from trades and ledger records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.records import TRADE, parse_delimited
from millrace.functions.text import joined_key
from millrace.operators.cells import rows_to_cells, slice_by_day, split_keyless
from millrace.sinks.folded import CONTINUE, FoldedBatches

# Balance keys, and the trade flags that add to or subtract from a stock balance.
STOCK_KEY = ("fundid", "secuid", "orgid", "market", "stkcode", "serverid")
FUND_KEY = ("fundid", "orgid", "moneytype", "serverid")
ADD_FLAGS = ("03", "0B", "0a", "0b", "0c", "0d", "0e", "0q", "1j", "3m")
SUBTRACT_FLAGS = ("04", "0S", "0f", "0g", "0h", "0i", "0j", "0r", "3n")
ALWAYS_FLAGS = ("03", "04")
DELTA = ["rowkey", "delta", "last_no", "last_day"]
CONFIRMED_MATCH = "0"


def seed_cells(snapshot: DataFrame, date_column: str, day: str, keys: Sequence[str]) -> DataFrame:
    """Balance cells of one day's snapshot."""
    return slice_by_day(snapshot, date_column, day).transform(rows_to_cells, keys)


def distinct_messages(messages: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Messages without repeated ones. The whole text is compared, not the columns that are parsed from it.

    ``keep`` names columns that follow from the text; only these are handed on, and a stream shuffles no text then.

    On a stream the state holds a digest and the length of every message seen, as a delivery guarantee without a time
    limit needs; :func:`distinct_within` forgets them.
    """
    if not messages.isStreaming:
        return messages.select(value, *keep).distinct().select(*keep) if keep else messages.dropDuplicates([value])
    out = keep or messages.columns
    return _digested(messages, value).select("_digest", "_length", *out).dropDuplicates(["_digest", "_length"]).select(*out)


def _digested(messages: DataFrame, value: str) -> DataFrame:
    return messages.withColumn("_digest", F.unhex(F.sha2(F.col(value).cast("string"), 256))).withColumn(
        "_length", F.octet_length(F.col(value).cast("string")))


def distinct_within(messages: DataFrame, day: Column, delay: str = "3 days", value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """A stream's messages without repeated ones, with state that ends ``delay`` after their trade day (a timestamp).

    A message is known by its SHA-256 and length while repeats of it may come. What comes later than that is dropped, also
    a first delivery, so that nothing counts twice: choose the delay by how late a day's trades may be. ``keep`` as in
    :func:`distinct_messages`.
    """
    out = keep or messages.columns
    marked = _digested(messages, value).select("_digest", "_length", day.alias("_day"), *out).withWatermark("_day", delay)
    return marked.dropDuplicatesWithinWatermark(["_digest", "_length"]).select(*out)


def counts(flag: Column, match_type: Column) -> Column:
    """Trades that move a balance: known flags, and outside the two basic ones only confirmed matches."""
    return flag.isin(*ADD_FLAGS, *SUBTRACT_FLAGS) & (
        flag.isin(*ALWAYS_FLAGS) | (match_type.cast("string") == CONFIRMED_MATCH))


def signed_quantity(flag: Column, quantity: Column) -> Column:
    return F.when(flag.isin(*ADD_FLAGS), quantity).when(flag.isin(*SUBTRACT_FLAGS), -quantity)


def stock_deltas(trades: DataFrame, after_day: int | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """``key, delta, no, day`` per counted trade, after columns to be carried; ``after_day`` keeps trades later than the seed.

    Trades without a complete key have no balance; :func:`rejects` gives them.
    """
    trades, _ = split_keyless(trades, STOCK_KEY)
    rows = trades if after_day is None else trades.where(F.col("trddate") > after_day)
    rows = rows.where(counts(F.col("bsflag"), F.col("matchtype")))
    return rows.select(*carried, joined_key(*map(F.col, STOCK_KEY)).alias("rowkey"),
                       signed_quantity(F.col("bsflag"), F.col("matchqty")).alias("delta"),
                       F.col("matchsno").alias("last_no"), F.col("trddate").alias("last_day"))


def distinct_deltas(messages: DataFrame, after_day: int | None = None, upto_day: int | None = None, value: str = "value") -> DataFrame:
    """:func:`stock_deltas` of text messages, each message once, for the days after one and up to another.

    What is filtered out of a message is filtered out of its repeats, so only messages that move a balance are compared,
    and a stream holds the digests of those alone.
    """
    trades = messages.select(F.col(value).alias("_message"), F.col(value)).transform(parse_delimited, TRADE, value)
    deltas = stock_deltas(trades if upto_day is None else trades.where(F.col("trddate") <= upto_day), after_day, ["_message"])
    return distinct_messages(deltas, "_message", DELTA)


def fund_deltas(trades: DataFrame, ledger: DataFrame, after_day: int | None = None) -> DataFrame:
    """Union of trade clearing amounts and ledger effects, as ``key, delta, no, day``.

    Records without a complete key have no balance; :func:`rejects` gives them.
    """
    trades, ledger = split_keyless(trades, FUND_KEY)[0], split_keyless(ledger, FUND_KEY)[0]
    key = joined_key(*map(F.col, FUND_KEY)).alias("rowkey")
    a = trades.select(key, F.col("clearamt").alias("delta"), F.col("matchsno").alias("last_no"),
                      F.col("trddate").alias("last_day"))
    b = ledger.select(key, F.col("fundeffect").alias("delta"), F.col("sno").alias("last_no"),
                      F.col("bizdate").alias("last_day"))
    both = a.unionByName(b)
    return both if after_day is None else both.where(F.col("last_day") > after_day)


def rejects(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records of which a part of the key is missing or cannot be read."""
    return split_keyless(records, keys)[1]


def sum_deltas(deltas: DataFrame) -> DataFrame:
    """One row per key: total change and the latest (day, no)."""
    total = deltas.groupBy("rowkey").agg(F.sum("delta").alias("delta"),
                                         F.max(F.struct("last_day", "last_no")).alias("_last"))
    return total.select("rowkey", "delta", "_last.last_no", "_last.last_day")


def running_balance(seed: DataFrame, deltas: DataFrame) -> DataFrame:
    """Seed ``(rowkey, balance)`` plus changes. Keys of either side are kept; one shuffle for both."""
    start = seed.select("rowkey", F.col("balance").alias("delta"), F.lit(None).cast("bigint").alias("last_no"),
                        F.lit(None).cast("bigint").alias("last_day"))
    merged = sum_deltas(start.unionByName(deltas.select("rowkey", "delta", "last_no", "last_day")))
    return merged.withColumnRenamed("delta", "balance")


def delta_store(path: str, new_run: str = CONTINUE) -> FoldedBatches:
    """Summed changes by batch id; a batch costs what it holds, and folding keeps the latest (day, no)."""
    return FoldedBatches(path, sum_deltas, new_run)


def delta_sink(path: str, to_deltas=sum_deltas, new_run: str = CONTINUE, after_day: int | None = None):
    """Stream sink: each batch's changes, summed per key. A replayed batch counts once, folded or not.

    When a checkpoint is lost, the next run is a new one. If its source goes on where the lost one ended, its batches add
    to what is there (``CONTINUE``). If the source is read from its beginning, ``AGAIN`` lets them replace what earlier
    runs wrote; ``after_day`` is the start day, whose balances are the seed: changes up to it are left out.
    """
    def prepare(deltas: DataFrame) -> DataFrame:
        return to_deltas(deltas if after_day is None else deltas.where(F.col("last_day") > after_day))

    return delta_store(path, new_run).sink(prepare)


def balances_from(spark: SparkSession, seed: DataFrame, path: str) -> DataFrame:
    """Balances now: the seed and all batches written by :func:`delta_sink`."""
    deltas = delta_store(path).read(spark)
    empty = spark.createDataFrame([], "rowkey STRING, delta BIGINT, last_no BIGINT, last_day BIGINT")
    return running_balance(seed, empty if deltas is None else deltas)


def compact(spark: SparkSession, path: str, upto: int) -> None:
    """Fold the batches up to ``upto``; balances stay as they are."""
    delta_store(path).compact(spark, upto)
