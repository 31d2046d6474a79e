"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut_lineage

#: Texts may be long, so a batch that goes to Python holds few rows.
ARROW_ROWS = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def narrow(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text alone, so that other columns cannot clash; a null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body uses it for every element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def map_texts(df: DataFrame, fn: Callable[[], Callable[[list], list]], schema: str, names: list[str],
              types: list[pa.DataType], text_col: str = "text") -> DataFrame:
    """Run a function over the texts of each Arrow batch and carry every other column along.

    ``fn`` is called once per task and gives the batch function, which takes the list of texts
    and gives one list per new column, so what it builds lives as long as the task. The text
    column is not returned, and a column with the name of a new one is replaced.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    kept = [c for c in df.columns if c != text_col and c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for batch in batches:
            found = work(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(v, t) for v, t in zip(found, types)], names=kept + names)

    types_of = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join([*(f"`{c}` {types_of[c]}" for c in kept), schema]))


def crc_part(id_col: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % parts


def thinned(order: Column, keep: int, count: Column) -> Column:
    """Whether a row is one of about ``2 * keep`` of ``count`` rows, by a hash; true of all if they are few.

    The rows with the smallest hashes are then picked from these, so that no task ever sorts a whole table.
    """
    return F.pmod(order, F.lit(1 << 30)) * count < F.lit(2 * keep).cast("double") * (1 << 30)


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges: one ``(node, root)`` row per node, the root the smallest.

    Union-find as alternating stars. A large star hangs every greater neighbour of a node on the
    smallest one, a small star does so for the smaller neighbours; edges never grow in number and
    trees become stars in a logarithmic number of rounds in practice. Neighbour lists are never
    collected: the smallest neighbour is an aggregate with partial results, joined back as its own
    checkpointed table, so that both sides of the join are plain shuffles that Spark splits if hot.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = cut_lineage(edges)
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        edges = cut_lineage(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct())
        low = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")))
        hung = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
