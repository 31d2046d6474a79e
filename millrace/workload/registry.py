"""Named queries over the data tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import millrace
from millrace.session import RECOMMENDED, is_local

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Settings that results depend on, and small-machine settings for local sessions."""
    for name in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit",
                 "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(name, RECOMMENDED[name])
    # Functions travel with their code, so executors need no copy of the package.
    cloudpickle.register_pickle_by_value(millrace)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, folder) -> DataFrame`` and its oracle."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return fn(spark, folder)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register
