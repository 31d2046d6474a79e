"""Batches of rows by run and id, of which older ones are folded into a base."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sinks.writers import write_partitioned

#: What a run that the store has not seen means: its rows add to what is there, or the source is read again from the
#: start day, and what earlier runs wrote is replaced.
CONTINUE, AGAIN = "continue", "again"


def _numbers(rows: DataFrame, *keys: str) -> set[tuple[int, ...]]:
    """Numbers in the folder names ``key=number`` of a table's files, from the listing alone."""
    pattern = re.compile("/".join(f"{k}=(\\d+)" for k in keys) + "/")
    return {tuple(map(int, m.groups())) for m in map(pattern.search, rows.inputFiles()) if m}


class FoldedBatches:
    """A folder of batches whose rows ``fold`` merges, in any order and in any grouping.

    A batch is known by its run and its id. A run is what shares a checkpoint: the id of the streaming query, which
    a restart keeps and a lost checkpoint changes. Runs are numbered as they come (``epochs/epoch=e``), and batch *n* is
    written to ``batches/epoch=e/batch_id=n``, so a replay overwrites what it wrote and batch 0 of a new run is no
    replay of batch 0 of the run before. A run that a later one has followed is refused: two streams would write at once.

    ``compact`` folds the batches up to an id into ``bases/epoch=e/upto=n`` and then points to it; readers take the
    newest base and the batches after its cut, so nothing counts twice and a batch that is replayed after it was
    folded changes nothing. Folded batches and older bases stay until the retention rule of the folder removes them.
    """

    def __init__(self, path: str, fold: Callable[[DataFrame], DataFrame], new_run: str = CONTINUE):
        if new_run not in (CONTINUE, AGAIN):
            raise ValueError(f"a new run may continue or start again, not {new_run!r}")
        self.path, self.fold, self.new_run = path, fold, new_run
        self._known: dict[int, tuple[str, bool]] = {}

    def _listed(self, spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame | None:
        try:
            reader = spark.read.schema(schema) if schema else spark.read
            return reader.parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _epochs(self, spark: SparkSession) -> list[tuple[int, str, bool]]:
        """The runs so far as (number, run, whether it started again). There is one row per checkpoint ever used."""
        rows = self._listed(spark, "epochs", "epoch INT, run STRING, again BOOLEAN")
        if rows is None:
            return []
        # The listing tells whether there is a new one; a number never gets another run.
        if {e for e, in _numbers(rows, "epoch")} != set(self._known):
            self._known = {r["epoch"]: (r["run"], r["again"]) for r in rows.collect()}
        return sorted((epoch, *run) for epoch, run in self._known.items())

    def _epoch_of(self, spark: SparkSession, run: str) -> int:
        known = self._epochs(spark)
        for epoch, name, _ in known:
            if name == run:
                if epoch < known[-1][0]:
                    raise ValueError(f"run {run!r} of {self.path} was followed by run {known[-1][1]!r}")
                return epoch
        epoch = known[-1][0] + 1 if known else 0
        row = spark.createDataFrame([(run, bool(known) and self.new_run == AGAIN)], "run STRING, again BOOLEAN")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/epochs/epoch={epoch}")
        return epoch

    def first_epoch(self, spark: SparkSession) -> int:
        """The run from which on batches count: the last one that started again."""
        return max((epoch for epoch, _, again in self._epochs(spark) if again), default=0)

    def upto(self, spark: SparkSession) -> tuple[int, int]:
        """The last run and batch id that the newest base holds, (-1, -1) without a base."""
        pointers = self._listed(spark, "pointers", "id BIGINT, epoch INT, upto INT")
        return (-1, -1) if pointers is None else max(_numbers(pointers, "epoch", "upto"), default=(-1, -1))

    def sink(self, prepare: Callable[[DataFrame], DataFrame] | None = None, run: str | None = None) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` handler. The run is the streaming query's id; outside a stream it is ``run`` or an empty one."""
        def handle(rows: DataFrame, batch_id: int) -> None:
            spark = rows.sparkSession
            query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
            epoch = self._epoch_of(spark, run if run is not None else query or "")
            if (epoch, batch_id) > self.upto(spark):
                out = prepare(rows) if prepare else rows
                out.write.mode("overwrite").parquet(f"{self.path}/batches/epoch={epoch}/batch_id={batch_id}")

        return handle

    def _batches(self, spark: SparkSession, after: tuple[int, int], last: tuple[int, int] | None = None) -> DataFrame | None:
        """Rows of the batches after a cut and up to another one, without those that a run which started again replaced."""
        rows = self._listed(spark, "batches")
        if rows is None:
            return None

        def beyond(cut):
            return (F.col("epoch") > cut[0]) | ((F.col("epoch") == cut[0]) & (F.col("batch_id") > cut[1]))

        rows = rows.where(beyond(after) & (F.col("epoch") >= self.first_epoch(spark)))
        return (rows if last is None else rows.where(~beyond(last))).drop("epoch", "batch_id")

    def _base(self, spark: SparkSession) -> tuple[tuple[int, int], DataFrame | None]:
        """The newest base that still counts, and its cut."""
        cut = self.upto(spark)
        if cut[0] < self.first_epoch(spark):
            return (-1, -1), None
        return cut, spark.read.parquet(f"{self.path}/bases/epoch={cut[0]}/upto={cut[1]}")

    def _parts(self, spark: SparkSession, last: tuple[int, int] | None = None) -> DataFrame | None:
        cut, base = self._base(spark)
        batches = self._batches(spark, cut, last)
        if base is None or batches is None:
            return batches if base is None else base
        return base.unionByName(batches)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All batches folded, or nothing if there is none yet."""
        parts = self._parts(spark)
        return None if parts is None else self.fold(parts)

    def _cut(self, spark: SparkSession, upto: int) -> tuple[int, int] | None:
        """The newest run with ``upto``, if the base does not hold it yet."""
        epochs = self._epochs(spark)
        cut = (epochs[-1][0], upto) if epochs else None
        return cut if cut and cut > self.upto(spark) else None

    def _point(self, spark: SparkSession, cut: tuple[int, int]) -> None:
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointers/epoch={cut[0]}/upto={cut[1]}")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the batches of the newest run up to ``upto``, and all of earlier ones, into a new base; the pointer comes
        last, so a lost run leaves no trace."""
        cut = self._cut(spark, upto)
        parts = cut and self._parts(spark, cut)
        if parts:
            self.fold(parts).write.mode("overwrite").parquet(f"{self.path}/bases/epoch={cut[0]}/upto={cut[1]}")
            self._point(spark, cut)


class FoldedRanges(FoldedBatches):
    """As :class:`FoldedBatches`, with a base in ranges of a key, of which a fold rewrites only those that its batches touch.

    The first fold cuts the ranges. Each range has a version: ``data/version=v/range=r``. A fold reads the touched
    ranges, merges its batches into them, writes them under the next version and then a new list of the versions of all
    ranges (``levels/epoch=e/upto=n``). Readers take from every range the version that the newest list names, so a range
    that no batch touches is never copied, and a fold that was lost leaves files that no list names.
    """

    def __init__(self, path: str, fold: Callable[[DataFrame], DataFrame], key: str, ranges: int = 64, new_run: str = CONTINUE):
        super().__init__(path, fold, new_run)
        self.key, self.ranges = key, ranges

    def _cuts(self, spark: SparkSession, rows: DataFrame) -> list:
        """The smallest key of every range but the first, from the first fold's rows; at most one per range."""
        stored = self._listed(spark, "cuts")
        if stored is None:
            ranged = rows.select(self.key).repartitionByRange(self.ranges, self.key)
            lows = ranged.groupBy(F.spark_partition_id().alias("_p")).agg(F.min(self.key).alias("low"))
            lows.where("low IS NOT NULL").select("low").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cuts")
            stored = spark.read.parquet(f"{self.path}/cuts")
        return sorted(r[0] for r in stored.collect())[1:]

    def versions(self, spark: SparkSession) -> dict[int, int]:
        """Version by range."""
        cut = self.upto(spark)
        if cut[0] < max(self.first_epoch(spark), 0):
            return {}
        rows = spark.read.schema("range INT, version INT").parquet(f"{self.path}/levels/epoch={cut[0]}/upto={cut[1]}")
        return {r["range"]: r["version"] for r in rows.collect()}

    def _ranges(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame | None:
        if not versions:
            return None
        by_version: dict[int, list[int]] = {}
        for r, v in versions.items():
            by_version.setdefault(v, []).append(r)
        named = F.lit(False)
        for v, rs in by_version.items():
            named = named | ((F.col("version") == v) & F.col("range").isin(rs))
        return spark.read.parquet(f"{self.path}/data").where(named).drop("version", "range")

    def _base(self, spark: SparkSession) -> tuple[tuple[int, int], DataFrame | None]:
        versions = self.versions(spark)
        return (self.upto(spark) if versions else (-1, -1)), self._ranges(spark, versions)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the batches up to ``upto`` into the ranges that they touch."""
        cut = self._cut(spark, upto)
        if not cut:
            return
        versions = self.versions(spark)
        batches = self._batches(spark, self.upto(spark) if versions else (-1, -1), cut)
        if batches is None:
            return
        cuts = self._cuts(spark, batches)
        place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(self.key))) if cuts else F.lit(0)
        placed = batches.withColumn("range", F.when(F.col(self.key).isNull(), 0).otherwise(place))
        touched = [r[0] for r in placed.select("range").distinct().collect()]
        version = max(versions.values(), default=-1) + 1
        old = self._ranges(spark, {r: v for r, v in versions.items() if r in touched})
        merged = self.fold(batches if old is None else old.unionByName(batches))
        merged = merged.withColumn("range", F.when(F.col(self.key).isNull(), 0).otherwise(place))
        write_partitioned(merged, f"{self.path}/data/version={version}", ["range"])
        now = spark.createDataFrame(sorted({**versions, **dict.fromkeys(touched, version)}.items()), "range INT, version INT")
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/levels/epoch={cut[0]}/upto={cut[1]}")
        self._point(spark, cut)
