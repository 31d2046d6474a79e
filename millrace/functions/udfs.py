"""User-defined functions: an Arrow form to register for SQL and a native twin to prefer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


@F.pandas_udf(T.StringType())
def hello_udf(s: pd.Series) -> pd.Series:
    return "hello " + s.fillna("null")


def hello(col: Column) -> Column:
    return F.concat(F.lit("hello "), F.coalesce(col, F.lit("null")))


#: Running state of an average: sums of values and of counts, which add up in any order.
def avg_state(col: Column) -> Column:
    return F.struct(F.sum(col).alias("total"), F.count(col).alias("n"))


def merge_avg_states(state: str) -> Column:
    return F.struct(F.sum(f"{state}.total").alias("total"), F.sum(f"{state}.n").alias("n"))


def finish_avg(state: Column) -> Column:
    """NULL for an empty group."""
    return F.try_divide(state["total"].cast("double"), state["n"])


def mergeable_average(df: DataFrame, keys: list[str], value: str, name: str, partial_by: list[str]) -> DataFrame:
    """Average per key out of per-``partial_by`` states, so partial results can be stored and merged later."""
    partial = df.groupBy(*keys, *partial_by).agg(avg_state(F.col(value)).alias("_state"))
    merged = partial.groupBy(*keys).agg(merge_avg_states("_state").alias("_state"))
    return merged.select(*keys, finish_avg(F.col("_state")).alias(name))


#: Buffers that a task merges before it sends them on.
PARTIAL_KEYS = 50_000


def user_aggregate(df: DataFrame, keys: list[str], buffer: str, result: str,
                   reduce: Callable[[pd.DataFrame], pd.DataFrame], merge: Callable[[pd.DataFrame], pd.DataFrame],
                   finish: Callable[[pd.DataFrame], pd.Series], name: str) -> DataFrame:
    """Aggregate written in Python, with partial results before the shuffle.

    ``reduce`` turns an Arrow batch of rows into one buffer row per key, ``merge`` combines buffer
    rows of equal keys, ``finish`` gives the result of a merged buffer. ``buffer`` and ``result`` are
    the DDL of the buffer columns and of the result. Only buffers are shuffled, and a task sees
    the buffers of a key as an iterator of batches, never as a whole.
    """
    key_ddl = ", ".join(f"`{k}` {t}" for k, t in df.select(*keys).dtypes)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged = None
        for batch in batches:
            found = reduce(batch)
            merged = found if merged is None else merge(pd.concat([merged, found], ignore_index=True))
            if len(merged) > PARTIAL_KEYS:  # very many keys: what is merged so far goes on
                yield merged
                merged = None
        if merged is not None:
            yield merged

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merged = None
        for batch in batches:
            merged = merge(batch if merged is None else pd.concat([merged, batch], ignore_index=True))
        yield merged[keys].assign(**{name: finish(merged)})

    buffers = df.mapInPandas(partial, f"{key_ddl}, {buffer}")
    return buffers.groupBy(*keys).applyInPandas(final, f"{key_ddl}, `{name}` {result}")


def register_functions(spark: SparkSession) -> None:
    """Make the functions callable from SQL.

    ``my_average`` is a SQL function over native expressions, so it keeps map-side
    partial aggregation; a grouped Pandas UDF would need whole groups in memory.
    """
    spark.udf.register("hello", hello_udf)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION my_average(total DOUBLE, n BIGINT) "
              "RETURNS DOUBLE RETURN try_divide(total, n)")
