"""A table for look-ups by key: hash buckets as folders, of which a batch opens only those that it needs."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.joins import drop_matching
from millrace.sinks.writers import bucket_count

#: Keys of a batch that are also compared in the scan, where min, max and Bloom filters of the files skip row groups.
PUSHED_KEYS = 1000


class BucketStore:
    """Rows under ``data/bucket=b``, where the bucket is a hash of the key, sorted by the key within a file.

    The number of buckets is part of the store and is fixed by its first write. Keys of the store are unique if
    :meth:`put_new` alone adds to it. A NULL in the key is in no bucket: such rows are not stored and find nothing.
    """

    def __init__(self, path: str, keys: Sequence[str]):
        self.path, self.keys = path, list(keys)

    def _bucket(self, buckets: int) -> Column:
        known = F.lit(True)
        for k in self.keys:
            known = known & F.col(k).isNotNull()
        return F.when(known, F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))

    def buckets(self, spark: SparkSession) -> int:
        return self._layout(spark)[0]

    def _layout(self, spark: SparkSession) -> tuple[int, T.StructType]:
        buckets, schema = spark.read.schema("buckets INT, schema STRING").parquet(f"{self.path}/layout").first()
        return buckets, T.StructType.fromJson(json.loads(schema))

    def create(self, rows: DataFrame, buckets: int | None = None, rows_per_bucket: int = 500_000) -> None:
        """A new store of these rows; without a number of buckets it follows the number of rows."""
        spark = rows.sparkSession
        buckets = buckets or bucket_count(rows.count(), rows_per_bucket)
        spark.createDataFrame([(buckets, rows.schema.json())], "buckets INT, schema STRING").coalesce(1).write.parquet(f"{self.path}/layout")
        self._add(rows, buckets, "overwrite")

    def _add(self, rows: DataFrame, buckets: int, mode: str) -> None:
        placed = rows.withColumn("bucket", self._bucket(buckets)).where("bucket IS NOT NULL")
        writer = placed.repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.mode(mode)
        for k in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        writer.partitionBy("bucket").parquet(f"{self.path}/data")

    def rows_for(self, batch: DataFrame) -> DataFrame:
        """The part of the store that can hold keys of a batch.

        At most as many numbers as there are buckets, and :data:`PUSHED_KEYS` keys, come to the driver; they become
        filters of the scan.
        """
        spark = batch.sparkSession
        buckets, schema = self._layout(spark)
        wanted = batch.select(*self.keys).dropna().distinct()
        needed = [r[0] for r in wanted.select(self._bucket(buckets)).distinct().collect()]
        rows = spark.read.schema(T.StructType([*schema, T.StructField("bucket", T.IntegerType())])).parquet(f"{self.path}/data")
        rows = rows.where(F.col("bucket").isin(needed))
        if len(self.keys) == 1:
            few = [r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()]
            if len(few) <= PUSHED_KEYS:
                rows = rows.where(F.col(self.keys[0]).isin(few))
        return rows.drop("bucket")

    def look_up(self, batch: DataFrame, how: str = "left") -> DataFrame:
        """Rows of the batch with the stored columns of their key; NULLs, or no row with ``inner``, where there is none."""
        return batch.join(self.rows_for(batch), self.keys, how)

    def absent(self, batch: DataFrame) -> DataFrame:
        """Rows of the batch whose key is not stored."""
        return drop_matching(batch, self.rows_for(batch), self.keys)

    def put_new(self, rows: DataFrame) -> None:
        """Add one row, the smallest, per key that is not stored. A batch that comes again adds nothing."""
        rest = [c for c in rows.columns if c not in self.keys]
        once = self.absent(rows).groupBy(*self.keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*self.keys, "_row.*")
        self._add(once.select(*rows.columns), self.buckets(rows.sparkSession), "append")
