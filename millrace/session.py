"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library wants, whatever the cluster size.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles methods above 8000 bytes of bytecode; beyond it, split code is faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    """Session with the recommended settings; keyword ``a__b`` sets ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_settings(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition settings for a job over ``input_bytes``: enough shuffle partitions that one fits in
    memory, which AQE then merges or splits towards the same size, and scan tasks of that size."""
    partitions = min(max(2 * cores, -(-input_bytes // partition_bytes)), 200_000)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def work_root(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``.

    On a cluster the setting is required. Only a local session, where the one
    machine is the whole cluster, falls back to a new temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the work folder."""
    return f"{work_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the rows live in the shared folder, so a lost executor costs nothing."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_root(spark))
    return df.checkpoint(eager)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read many: a Parquet table in the shared folder instead of a cache."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that are through.

    It does so when the driver finds nothing that refers to them, hence not before its memory is collected, which
    may be long after a job of many steps has filled the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
