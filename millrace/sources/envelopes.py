"""Message envelopes ``(key binary, value binary, timestamp)`` of any stream or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.records import parse_json

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])


def to_envelope(df: DataFrame, key: str, ts: str, *payload: str) -> DataFrame:
    """Rows as JSON messages."""
    return df.select(
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*payload)), "UTF-8").alias("value"),
        F.col(ts).cast("timestamp").alias("timestamp"),
    )


def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Message payload as typed columns next to the text key and the message time."""
    rows = df.select(F.decode("key", "UTF-8").alias("message_key"),
                     F.col("timestamp").alias("message_time"), "value")
    return parse_json(rows, schema)
