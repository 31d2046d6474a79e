"""Samples, splits and physical layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def keyed_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The same rows on every run: a row is in the sample when its key's hash is below the fraction."""
    scale = 1_000_000
    return df.where(F.pmod(F.xxhash64(key), F.lit(scale)) < int(fraction * scale))


def keyed_split(df: DataFrame, key: str, weights: list[float]) -> list[DataFrame]:
    """Disjoint parts that cover all rows, by ranges of the key's hash; needs no sort and no cache."""
    scale = 1_000_000
    total, edges = sum(weights), [0]
    for w in weights:
        edges.append(edges[-1] + w / total * scale)
    edges = [round(e) for e in edges[:-1]] + [scale]
    slot = F.pmod(F.xxhash64(key), F.lit(scale))
    return [df.where((slot >= lo) & (slot < hi)) for lo, hi in zip(edges, edges[1:])]


def stratified_sample(df: DataFrame, column: str, fractions: Mapping, seed: int) -> DataFrame:
    return df.sampleBy(column, dict(fractions), seed)


def layout(df: DataFrame, partitions: int, by: Column | str | None = None, ranged: bool = False) -> DataFrame:
    """Hash or range partitioning by a column, or a plain merge of partitions when none is given."""
    if by is None:
        return df.coalesce(partitions)
    return df.repartitionByRange(partitions, by) if ranged else df.repartition(partitions, by)
