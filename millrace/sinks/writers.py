"""Batch sinks and idempotent stream sinks."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error",
                partition_by: Sequence[str] = (), **options) -> None:
    df.write.format(fmt).mode(mode).options(**options).partitionBy(*partition_by).save(path)


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Directory per key value. Rows are clustered first, so that a task does not open a file per key.

    The clustering is a rebalance: Spark splits a large key over as many tasks as its bytes need.
    """
    df.createOrReplaceTempView("mr_rebalanced")
    names = ", ".join(f"`{k}`" for k in keys)
    clustered = df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM mr_rebalanced")
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def bucket_count(rows: int, rows_per_bucket: int = 2_000_000, least: int = 8) -> int:
    """Buckets for a table of so many rows: a power of two, so that tables of different sizes still line up."""
    return max(least, 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length())


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str]) -> None:
    """Bucketed and sorted table: later joins and groupings on ``keys`` need no shuffle."""
    (df.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def write_jdbc(df: DataFrame, url: str, dbtable: str, properties: dict[str, str],
               column_types: str | None = None, mode: str = "append", connections: int = 8) -> None:
    """JDBC write; ``connections`` bounds the parallel sessions that the database sees."""
    writer = df.coalesce(connections).write.mode(mode)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, dbtable, properties=properties)


def to_messages(df: DataFrame, topic: str, key: str) -> DataFrame:
    """``(topic, key, value)`` with the non-NULL fields of the row as JSON."""
    payload = [c for c in df.columns if c != key]
    return df.select(F.lit(topic).alias("topic"), F.col(key).alias("key"),
                     F.to_json(F.struct(*payload)).alias("value"))


def batch_folder_sink(path: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """``foreachBatch`` handler that writes batch *n* to ``path/batch_id=n``.

    A replayed batch overwrites its own folder, so every record lands exactly once.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        out = prepare(rows) if prepare else rows
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches written by :func:`batch_folder_sink`, with their ``batch_id``."""
    return spark.read.parquet(path)


class JsonLines:
    """Target of :class:`RowWriter`: one file of JSON lines per task and batch, which a task that runs again overwrites."""

    def __init__(self, path: str):
        files, name = pafs.FileSystem.from_uri(path)
        files.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(name)

    @staticmethod
    def below(path: str) -> Callable[[int, int], JsonLines]:
        """``connect`` for files ``batch_id=e/part-p.json`` below a folder."""
        return lambda partition_id, epoch_id: JsonLines(f"{path}/batch_id={epoch_id}/part-{partition_id}.json")

    def write(self, row) -> None:
        self.out.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())

    def close(self) -> None:
        self.out.close()


class RowWriter:
    """Row-wise stream writer with ``open``/``process``/``close``, for targets that only take single rows.

    ``connect(partition_id, epoch_id)`` is called once per task and returns an object with
    ``write(row)`` and ``close()``.
    """

    def __init__(self, connect: Callable):
        self.connect = connect
        self.target = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.target = self.connect(partition_id, epoch_id)
        return self.target is not None

    def process(self, row) -> None:
        self.target.write(row)

    def close(self, error) -> None:
        if self.target is not None:
            self.target.close()
