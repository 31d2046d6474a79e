"""Bank transfers: JSON ledger messages to text rows, merged by row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.records import LEDGER_JSON, parse_json
from millrace.functions.text import joined_key, null_to_empty
from millrace.sinks.folded import FoldedBatches

# Business codes of transfers; output column by input column; row key columns.
TRANSFER_CODES = ("160021", "160022", "140055", "140057")
OUTPUT_COLUMNS = {
    "sno": "sno",
    "cust_id": "custid",
    "cust_name": "custname",
    "cptl_acid": "fundid",
    "reverse_cptl_acid": "fundid",
    "crrc_cd": "moneytype",
    "brch_id": "orgid",
    "cptl_occr_amt": "fundeffect",
    "operdate": "operdate",
    "orde_dt": "orderdate",
    "orde_time": "ordertime",
    "busi_digt_cd": "digestid",
    "etl_dt": "bizdate",
}
KEY_COLUMNS = ("reverse_cptl_acid", "operdate", "etl_dt", "sno")


def transfer_rows(messages: DataFrame, value: str = "value", codes: Sequence[str] = TRANSFER_CODES) -> DataFrame:
    """JSON messages to the 13 text columns and their row key; other columns are carried along."""
    carried = [c for c in messages.columns if c != value]
    return project_transfers(parse_json(messages, LEDGER_JSON, value), carried, codes)


def project_transfers(records: DataFrame, carried: Sequence[str] = (),
                      codes: Sequence[str] = TRANSFER_CODES) -> DataFrame:
    """Ledger records, from messages or a table, to transfer rows. NULL fields become empty text.

    The account is reversed in the key, because account numbers share their first digits.
    """
    code_type = records.schema["digestid"].dataType
    kept = records.where(F.col("digestid").isin(*[F.lit(c).cast(code_type) for c in codes]))
    rows = kept.select(*carried, *[
        (F.reverse(null_to_empty(F.col(src))) if out == "reverse_cptl_acid" else null_to_empty(F.col(src))).alias(out)
        for out, src in OUTPUT_COLUMNS.items()])
    return rows.withColumn("rowkey", joined_key(*map(F.col, KEY_COLUMNS)))


def merge_transfers(rows: DataFrame, version: Sequence[str]) -> DataFrame:
    """One row per row key, newest by the version columns.

    All columns of a transfer are written together, hence the newest row replaces the whole row.
    """
    newest = rows.groupBy("rowkey").agg(F.max(F.struct(*version, *OUTPUT_COLUMNS)).alias("_new"))
    return newest.select("rowkey", *[F.col(f"_new.{c}").alias(c) for c in OUTPUT_COLUMNS])


def transfer_store(path: str, version: Sequence[str]) -> FoldedBatches:
    """Stored transfers that batches upsert into, newest by the version columns."""
    def fold(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy("rowkey").agg(F.max(F.struct(*version, *OUTPUT_COLUMNS)).alias("_new"))
        return newest.select("rowkey", "_new.*")

    return FoldedBatches(path, fold)


def read_transfers(spark: SparkSession, path: str, version: Sequence[str]) -> DataFrame:
    """Merged transfers of the store."""
    return transfer_store(path, version).read(spark).select("rowkey", *OUTPUT_COLUMNS)

