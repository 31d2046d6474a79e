"""Rows as row-keyed cells ``(rowkey, family, qualifier, value)`` and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import joined_key
from millrace.functions.types import as_text
from millrace.sinks.folded import FoldedBatches, FoldedRanges

FAMILY = "cf"
CELL_COLUMNS = ["rowkey", "family", "qualifier", "value"]


def slice_by_day(df: DataFrame, date_column: str | None, day: str) -> DataFrame:
    """Rows of one business day; ``-1`` or a table without date column means all rows.

    The literal takes the column's own type, so the filter prunes partitions and row groups.
    """
    if day == "-1" or not date_column:
        return df
    return df.where(F.col(date_column) == F.lit(day).cast(df.schema[date_column].dataType))


def row_key(df: DataFrame, keys: Sequence[str]) -> Column:
    return joined_key(*[as_text(F.col(k), df.schema[k].dataType) for k in keys])


def split_keyless(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete key, rejected rows)."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.where(~missing), df.where(missing)


def rows_to_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                  family: str = FAMILY) -> DataFrame:
    """One cell per non-NULL column. Rows without a complete key have no cells; see :func:`split_keyless`.

    A narrow operation: cells stay in the partition of their row.
    """
    names = list(columns or df.columns)
    texts = df.select(
        row_key(df, keys).alias("rowkey"),
        *[as_text(F.col(c), df.schema[c].dataType).alias(c) for c in names],
    ).where(F.col("rowkey").isNotNull())
    cells = texts.unpivot("rowkey", names, "qualifier", "value").where(F.col("value").isNotNull())
    return cells.select("rowkey", F.lit(family).alias("family"), "qualifier", "value")


def cells_to_wide(cells: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cells back to one row per key with the chosen qualifiers as typed columns.

    One conditional aggregate per qualifier: partial results combine before the shuffle.
    """
    picks = [F.max(F.when(F.col("qualifier") == q, F.col("value"))).try_cast(t).alias(q) for q, t in types.items()]
    return cells.where(F.col("qualifier").isin(list(types))).groupBy("rowkey").agg(*picks)


def key_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """Row keys in ``[start, stop)``; on a sorted export only the matching row groups are read."""
    return cells.where((F.col("rowkey") >= start) & (F.col("rowkey") < stop))


def export_sorted(cells: DataFrame, path: str, partitions: int | None = None) -> None:
    """Globally sorted export: files hold disjoint key ranges, each sorted by (rowkey, qualifier).

    Ranges are cut by the pair, so that one very wide or very frequent key can span files.
    """
    order = ["rowkey", "qualifier"]
    ranged = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def latest_cells(cells: DataFrame, version: Sequence[str]) -> DataFrame:
    """Newest value per (rowkey, family, qualifier) by the version columns, then by value for ties."""
    newest = F.max(F.struct(*version, "value")).alias("_newest")
    merged = cells.groupBy("rowkey", "family", "qualifier").agg(newest)
    return merged.select("rowkey", "family", "qualifier", F.col("_newest.value").alias("value"))


def latest_versions(cells: DataFrame, version: Sequence[str]) -> DataFrame:
    """As :func:`latest_cells`, with the version columns kept, so that results can be merged again."""
    newest = F.max(F.struct(*version, "value")).alias("_newest")
    return cells.groupBy("rowkey", "family", "qualifier").agg(newest).select("rowkey", "family", "qualifier", "_newest.*")


def cell_store(path: str, version: Sequence[str]) -> FoldedBatches:
    """Stored cells that batches upsert into: a batch costs what it holds, and a replay changes nothing."""
    return FoldedBatches(path, lambda cells: latest_versions(cells, version))


def ranged_cell_store(path: str, version: Sequence[str], ranges: int = 64) -> FoldedRanges:
    """As :func:`cell_store`, in ranges of the row key: folding rewrites only ranges that its batches touch."""
    return FoldedRanges(path, lambda cells: latest_versions(cells, version), "rowkey", ranges)


def keyed_upsert(existing: DataFrame, incoming: DataFrame, version: Sequence[str]) -> DataFrame:
    """Cell-level upsert: a column that is absent from a newer row keeps its older value."""
    return latest_cells(existing.unionByName(incoming), version)
