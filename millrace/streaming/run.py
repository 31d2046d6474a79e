"""Run a streaming DataFrame over all available input and read back its result."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from millrace.session import work_path
from millrace.sinks.writers import batch_folder_sink


@contextmanager
def retained(spark: SparkSession, batches: int | None):
    """Queries started within keep the state of so many batches, by Spark's setting if none are given."""
    name = "spark.sql.streaming.minBatchesToRetain"
    before = spark.conf.get(name)
    if batches is not None:
        spark.conf.set(name, str(batches))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_available_now(stream: DataFrame, mode: str = "append", checkpoint: str | None = None,
                      out: str | None = None, retain: int | None = None) -> DataFrame:
    """Process what the sources hold now, then stop; the result is read from files, never collected.

    ``append`` uses the transactional file sink. ``complete`` writes each batch's full result to
    its own folder and returns the newest; ``update`` returns every changed row with its batch.
    With ``retain``, the checkpoint keeps the state of that many batches (a restart needs the last one); Spark keeps 100.
    """
    spark = stream.sparkSession
    out = out or work_path(spark, "stream-out")
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True).option(
        "checkpointLocation", checkpoint or work_path(spark, "stream-checkpoint"))
    if mode == "append":
        with retained(spark, retain):
            query = writer.format("parquet").option("path", out).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    with retained(spark, retain):
        query = writer.foreachBatch(batch_folder_sink(out)).start()
    query.awaitTermination()
    try:
        written = spark.read.parquet(out)
    except AnalysisException as error:  # no input yet, hence no batch
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], stream.schema)
    if mode == "update":
        return written
    newest = written.agg(F.max("batch_id")).first()[0]  # a partition column: answered from the listing
    return spark.read.schema(stream.schema).parquet(f"{out}/batch_id={newest}")


def run_foreach_batch(stream: DataFrame, handle, checkpoint: str | None = None, mode: str = "append") -> None:
    """Process what is available with ``handle(rows, batch_id)``."""
    checkpoint = checkpoint or work_path(stream.sparkSession, "stream-checkpoint")
    (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).foreachBatch(handle).start().awaitTermination())


def start_continuous(stream: DataFrame, handle, checkpoint: str, every: str = "1 second", name: str | None = None):
    """Long-running form of :func:`run_foreach_batch` with a processing-time trigger."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every)
    return (writer.queryName(name) if name else writer).foreachBatch(handle).start()


class ProgressLog(StreamingQueryListener):
    """Progress of one query's batches, as Spark reports it, and whether the query has ended."""

    def __init__(self, observed: str):
        self.observed, self.batches, self.ended, self.query = observed, {}, threading.Event(), None

    def onQueryStarted(self, event) -> None:
        """The query is told apart by its id, which the caller sets."""

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.observed)
        if str(p.id) == self.query and seen is not None:
            self.batches[p.batchId] = (p.numInputRows, seen.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query:
            self.ended.set()


def run_observed(stream: DataFrame, handle, metrics: Sequence[Column], timeout: float, checkpoint: str | None = None) -> tuple[DataFrame, bool]:
    """Process what is available with ``handle(rows, batch_id)`` and return one row per batch with its metrics.

    ``metrics`` are named aggregates that Spark computes while the rows pass, without a further scan. The wait is bounded:
    after ``timeout`` seconds the query is stopped and the second result is false; a later run goes on from the checkpoint.
    Columns are ``batch_id, input_rows`` and the metrics, as text.
    """
    spark, log = stream.sparkSession, ProgressLog(f"metrics_{uuid.uuid4().hex}")
    spark.streams.addListener(log)
    try:
        query = (stream.observe(log.observed, *metrics).writeStream.trigger(availableNow=True).foreachBatch(handle)
                 .option("checkpointLocation", checkpoint or work_path(spark, "stream-checkpoint")).start())
        log.query = query.id
        done = query.awaitTermination(timeout)
        if not done:
            query.stop()
        for p in query.recentProgress:  # what was reported before the listener knew the query
            seen = p.observedMetrics.get(log.observed)
            if seen is not None:
                log.batches.setdefault(p.batchId, (p.numInputRows, seen.asDict()))
        log.ended.wait(10)
    finally:
        spark.streams.removeListener(log)
    names = [f"m{i}" for i in range(len(metrics))] if not log.batches else list(next(iter(log.batches.values()))[1])
    rows = [(i, n, *[None if v is None else str(v) for v in seen.values()]) for i, (n, seen) in sorted(log.batches.items())]
    return spark.createDataFrame(rows, ", ".join(["batch_id BIGINT", "input_rows BIGINT", *[f"`{c}` STRING" for c in names]])), bool(done)


def stream_sql(spark: SparkSession, stream: DataFrame, view: str, query: str) -> DataFrame:
    """SQL text over a streaming DataFrame registered as ``view``."""
    stream.createOrReplaceTempView(view)
    return spark.sql(query)
