"""Incremental reads of a growing table by an offset column.

``offset_slice`` works on any DataFrame, JDBC tables included, and its range filter is pushed
into the scan. ``poll`` drives it: each call hands over the rows that are new since the last
call, in slices of a bounded size if one is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.types import type_by_name


def offset_column(df: DataFrame, spec: str) -> tuple[Column, T.DataType]:
    """``column`` or ``expression:type``; a bare column takes its own type."""
    expr, _, type_name = spec.rpartition(":")
    if expr:
        return F.expr(expr), type_by_name(type_name)
    fields = {f.name.lower(): f for f in df.schema.fields}
    if spec.lower() not in fields:
        raise ValueError(f"offset column {spec!r} not in {df.columns}")
    field = fields[spec.lower()]
    return F.col(field.name), field.dataType


def offset_bounds(df: DataFrame, spec: str) -> DataFrame:
    """One row with the smallest and largest offset; NULL offsets do not count."""
    col, dtype = offset_column(df, spec)
    return df.agg(F.min(col.cast(dtype)).alias("min_offset"), F.max(col.cast(dtype)).alias("max_offset"))


def offset_slice(df: DataFrame, spec: str, start, end, inclusive: bool) -> DataFrame:
    """Rows with offset in ``[start, end]``, or ``(start, end]`` for a follow-up slice."""
    col, dtype = offset_column(df, spec)
    low, high = F.lit(str(start)).cast(dtype), F.lit(str(end)).cast(dtype)
    return df.where(((col >= low) if inclusive else (col > low)) & (col <= high))


def poll(table: DataFrame, spec: str, state_path: str, handle: Callable[[DataFrame, int], None],
         starting: str = "earliest", max_rows: int | None = None) -> bool:
    """Hand the next slice to ``handle(rows, batch_id)``; false when nothing is new.

    With ``max_rows`` a slice holds about that many rows: its end is an offset that the table has, found
    by a sketch, and the next call goes on after it, so no row is lost. Rows of one offset stay together.

    The range is logged before the batch runs and confirmed after it, so a batch that was cut
    short is handed over again with the same id and range. ``handle`` must therefore be
    idempotent per batch id, like every sink in :mod:`millrace.sinks`.
    """
    spark = table.sparkSession
    log = _read_log(spark, state_path)
    if log and not log[-1]["done"]:
        entry = log[-1]
    else:
        entry = _next_range(table, spec, log[-1] if log else None, starting, max_rows)
        if entry is None:
            return False
        _write_log(spark, state_path, {**entry, "done": False})
    handle(offset_slice(table, spec, entry["start"], entry["end"], entry["inclusive"]), entry["id"])
    _write_log(spark, state_path, {**entry, "done": True})
    return True


def _next_range(table: DataFrame, spec: str, last: dict | None, starting: str, max_rows: int | None) -> dict | None:
    """The first range of a table, or the range after the last one; None when it holds nothing."""
    col, dtype = offset_column(table, spec)
    if last is None:
        lo, hi = offset_bounds(table, spec).first()
        if hi is None:
            return None
        entry = {"id": 0, "start": {"earliest": lo, "latest": hi}.get(starting, starting), "inclusive": True}
        newer = table.where(col >= F.lit(str(entry["start"])).cast(dtype))
    else:
        # Only rows beyond the last end are looked at, so the scan can skip the files read before.
        entry = {"id": last["id"] + 1, "start": last["end"], "inclusive": False}
        newer = table.where(col > F.lit(last["end"]).cast(dtype))
    top = [F.max(col.cast(dtype)), F.count(col)]
    hi, n = newer.agg(*top).first()
    if hi is None:
        return None
    if max_rows and n > max_rows:
        hi = newer.agg(F.percentile_approx(col.cast(dtype), max_rows / n, 10_000)).first()[0]
    return {**entry, "end": hi}


_ENTRY = "id BIGINT, start STRING, `end` STRING, inclusive BOOLEAN, done BOOLEAN"
_LOG = f"{_ENTRY}, batch BIGINT"


def _read_log(spark: SparkSession, path: str) -> list[dict]:
    """The newest log entry, in a list. There is one folder per batch; the listing tells the newest."""
    try:
        log = spark.read.schema(_LOG).json(path)
        newest = log.agg(F.max("batch")).first()[0]
        last = log.where(F.col("batch") == newest).collect()
    except AnalysisException as error:  # no log yet
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r.asDict() for r in last]


def _write_log(spark: SparkSession, path: str, entry: dict) -> None:
    """A batch's entry; that it is done replaces that it began."""
    row = (entry["id"], str(entry["start"]), str(entry["end"]), entry["inclusive"], entry["done"])
    spark.createDataFrame([row], _ENTRY).coalesce(1).write.mode("overwrite").json(f"{path}/batch={entry['id']}")
