"""Sources and sinks: every query writes or reads whole tables through a file, table or slice."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel, TaskContext
from pyspark.sql import functions as F, types as T

from millrace.functions.dates import compact_day
from millrace.functions.records import parse_delimited
from millrace.functions.text import joined_key, padded_key, salted_key
from millrace.functions.types import schema_from_names
from millrace.operators.cells import (cells_to_wide, export_sorted, key_range, cell_store, ranged_cell_store, rows_to_cells)
from millrace.session import cut_lineage, work_path
from millrace.sinks import writers
from millrace.sinks.buckets import BucketStore
from millrace.sources import files, incremental
from millrace.sources.files import table
from millrace.workload.registry import query


def _temp_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


# --- file scans ------------------------------------------------------------------------------


@query("scan_parquet", "SELECT o_orderkey, o_totalprice FROM orders")
def scan_parquet(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice")


@query("scan_json_roundtrip", """
SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM orders""")
def scan_json_roundtrip(spark, d):
    """NULL fields are absent in the file and come back as NULL."""
    path = work_path(spark, "orders-json")
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    writers.write_files(o, path, "json")
    return files.read_json(spark, path, o.schema)


@query("scan_json_inferred", "SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def scan_json_inferred(spark, d):
    path = work_path(spark, "customer-json")
    c = table(spark, d, "customer")
    writers.write_files(c.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")),
                        path, "json", "overwrite")
    return files.read_json(spark, path).select("c_custkey", "c_name", "segment")


@query("scan_csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def scan_csv_roundtrip(spark, d):
    path = work_path(spark, "customer-csv")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    writers.write_files(c, path, "csv", sep=";", header=True)
    return files.read_csv(spark, path, c.schema, sep=";")


@query("scan_csv_inferred", "SELECT s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv_inferred(spark, d):
    path = work_path(spark, "supplier-csv")
    writers.write_files(table(spark, d, "supplier").select("s_name", "s_nationkey", "s_acctbal"), path, "csv",
                        sep=";", header=True)
    return files.read_csv(spark, path, sep=";")


@query("sql_on_file", "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1")
def sql_on_file(spark, d):
    return files.sql_on_path(spark, f"{d}/lineitem.parquet").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("merge_schema", """
SELECT c_custkey AS id, c_name AS label, CAST(NULL AS DOUBLE) AS price, 1 AS key FROM customer
UNION ALL SELECT p_partkey, NULL, p_retailprice, 2 FROM part""")
def merge_schema(spark, d):
    """Two directories with different columns, and the directory name as a column."""
    root = work_path(spark, "merged")
    table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label")).write.parquet(f"{root}/key=1")
    table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price")).write.parquet(f"{root}/key=2")
    return files.read_merged(spark, root).select("id", "label", "price", "key")


@query("text_line_counts", """
SELECT count(*) AS n_lines, count(*) FILTER (contains(line, 'a')) AS n_a, count(*) FILTER (contains(line, 'b')) AS n_b
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""")
def text_line_counts(spark, d):
    """Lines of the documents, written as a text file and read back."""
    path = work_path(spark, "lines")
    table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.agg(F.count("*").alias("n_lines"), F.count_if(F.contains("value", F.lit("a"))).alias("n_a"),
                     F.count_if(F.contains("value", F.lit("b"))).alias("n_b"))


@query("word_count", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1""")
def word_count(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _delimited(spark, d, label):
    path = work_path(spark, label)
    table(spark, d, "customer").select(F.concat_ws(", ", "c_name", "c_nationkey")).write.text(path)
    return files.read_lines(spark, path)


@query("delimited_to_rows", "SELECT c_name AS name, c_nationkey AS nation FROM customer")
def delimited_to_rows(spark, d):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("nation", T.IntegerType())])
    return parse_delimited(_delimited(spark, d, "typed-lines"), schema, trim=True)


@query("schema_from_string", "SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def schema_from_string(spark, d):
    return parse_delimited(_delimited(spark, d, "text-lines"), schema_from_names("name nation"), trim=True)


@query("inline_rows", """
SELECT o_orderkey, o_orderpriority, rank FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3))
v(p, rank) ON o_orderpriority = p""")
def inline_rows(spark, d):
    ranks = spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], "o_orderpriority STRING, rank INT")
    return table(spark, d, "orders").join(ranks, "o_orderpriority").select("o_orderkey", "o_orderpriority", "rank")


@query("range_gen", """
SELECT r.id, count(o_orderkey) AS n_orders FROM (SELECT unnest(range(0, (SELECT max(c_custkey) + 1 FROM customer))) AS id) r
LEFT JOIN orders ON o_custkey = r.id GROUP BY 1""")
def range_gen(spark, d):
    """A generated key range up to the largest customer key, so that keys without orders are counted too."""
    top = table(spark, d, "customer").agg(F.max("c_custkey")).first()[0]
    per_customer = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"))
    return spark.range(top + 1).join(per_customer, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("recursive_scan", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders""")
def recursive_scan(spark, d):
    """Nested directories that are not key=value partitions."""
    root = work_path(spark, "nested")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    o.where("o_orderstatus = 'O'").write.parquet(f"{root}/1/open")
    o.where("o_orderstatus <> 'O'").write.parquet(f"{root}/2/closed/all")
    return files.read_recursive(spark, root, o.schema)


@query("partitioned_write", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def partitioned_write(spark, d):
    """Directory per status; the filter on it prunes whole directories."""
    path = work_path(spark, "orders-by-status")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_partitioned(o, path, ["o_orderstatus"])
    return spark.read.parquet(path).where("o_orderstatus <> 'P'")


# --- tables ----------------------------------------------------------------------------------


@query("bucketed_table", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def bucketed_table(spark, d):
    """Two tables bucketed on the join key: the join reads them without a shuffle."""
    o, c = _temp_name("mr_orders_b"), _temp_name("mr_customer_b")
    buckets = writers.bucket_count(table(spark, d, "orders").count())
    writers.write_bucketed(table(spark, d, "orders").select("o_custkey", "o_orderkey"), o, work_path(spark, o), buckets, ["o_custkey"])
    writers.write_bucketed(table(spark, d, "customer").select("c_custkey", "c_name"), c, work_path(spark, c), buckets, ["c_custkey"])
    return spark.table(o).join(spark.table(c).hint("merge"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("managed_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def managed_table(spark, d):
    """Created by DDL, then filled from a DataFrame."""
    name = _temp_name("mr_supplier")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (s_suppkey BIGINT, s_name STRING, s_nationkey INT) "
              f"USING parquet LOCATION '{work_path(spark, name)}'")
    table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.mode("overwrite").insertInto(name)
    return spark.table(name)


@query("catalog_table_scan", "SELECT p_partkey, p_brand, p_size FROM part")
def catalog_table_scan(spark, d):
    name = _temp_name("mr_part")
    table(spark, d, "part").select("p_partkey", "p_brand", "p_size").write.option("path", work_path(spark, name)).saveAsTable(name)
    return spark.table(name)


@query("external_table", "SELECT n_nationkey, n_name, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def external_table(spark, d):
    """A table over Parquet files that already exist."""
    path, name = work_path(spark, "customer-files"), _temp_name("mr_customer_x")
    table(spark, d, "customer").select("c_custkey", "c_nationkey").write.parquet(path)
    spark.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_nationkey INT) USING parquet LOCATION '{path}'")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return spark.table(name).join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "n_name", "c_custkey")


@query("load_delimited_table", "SELECT c_custkey AS key, c_name AS value FROM customer")
def load_delimited_table(spark, d):
    """A file with \\x01 between its fields, loaded into a table."""
    path, name = work_path(spark, "kv-text"), _temp_name("mr_kv")
    kv = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))
    writers.write_files(kv, path, "csv", sep="\x01")
    spark.sql(f"CREATE TABLE {name} (key BIGINT, value STRING) USING parquet LOCATION '{work_path(spark, name)}'")
    files.read_csv(spark, path, kv.schema, sep="\x01", header=False).write.insertInto(name)
    return spark.table(name)


@query("global_view", "SELECT c_custkey, c_mktsegment FROM customer")
def global_view(spark, d):
    name = _temp_name("mr_segments")
    table(spark, d, "customer").select("c_custkey", "c_mktsegment").createOrReplaceGlobalTempView(name)
    return spark.newSession().table(f"global_temp.{name}")


@query("checkpoint_same_rows", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def checkpoint_same_rows(spark, d):
    """Lineage cut in the shared folder, so the result survives the loss of executors."""
    counts = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return cut_lineage(counts)


@query("table_ddl", "SELECT n_nationkey, n_name, false AS dropped_left FROM nation")
def table_ddl(spark, d):
    """Tables that are created if they do not exist and dropped if they do, each said twice."""
    kept, dropped = _temp_name("mr_nation"), _temp_name("mr_dropped")
    for name in (kept, dropped, kept, dropped):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (n_nationkey INT, n_name STRING) USING parquet LOCATION '{work_path(spark, name)}'")
    table(spark, d, "nation").select("n_nationkey", "n_name").write.insertInto(kept)
    for _ in range(2):
        spark.sql(f"DROP TABLE IF EXISTS {dropped}")
    return spark.table(kept).withColumn("dropped_left", F.lit(spark.catalog.tableExists(dropped)))


@query("catalog_cells", """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'cf' AS family, q AS qualifier, v AS value FROM customer, LATERAL (VALUES
  ('c_custkey', CAST(c_custkey AS VARCHAR)), ('c_name', c_name), ('c_nationkey', CAST(c_nationkey AS VARCHAR))) x(q, v) WHERE v IS NOT NULL""")
def catalog_cells(spark, d):
    """A job that knows its table by name only: columns and types come from the catalog."""
    name = _temp_name("mr_customer_c")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey").write.option("path", work_path(spark, name)).saveAsTable(name)
    types = files.catalog_column_types(spark, name)
    rows = spark.table(name).select(*[F.col(c).cast(t) for c, t in types.items()])
    return rows_to_cells(rows, [next(iter(types))], list(types))


@query("foreach_partition", "SELECT s_suppkey, s_name FROM supplier")
def foreach_partition(spark, d):
    """Each partition written by a function of its rows, to one file per task, and read back."""
    out = work_path(spark, "by-partition")

    def write(rows) -> None:
        target = writers.JsonLines(f"{out}/part-{TaskContext.get().partitionId()}.json")
        for row in rows:
            target.write(row)
        target.close()

    table(spark, d, "supplier").select("s_suppkey", "s_name").foreachPartition(write)
    return spark.read.schema("s_suppkey BIGINT, s_name STRING").json(out)


@query("persisted", """
SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders WHERE o_totalprice > 100000) AS n_all FROM orders WHERE o_totalprice > 100000 GROUP BY 1""")
def persisted(spark, d):
    """Rows kept in memory and on disk for two uses; unlike a checkpoint, lost ones are computed again."""
    kept = table(spark, d, "orders").where("o_totalprice > 100000").persist(StorageLevel.MEMORY_AND_DISK)
    n = kept.count()
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("n_all", F.lit(n).cast("bigint"))


# --- cells -----------------------------------------------------------------------------------

ORDER_KEY = ["o_custkey", "o_orderkey"]


def order_slice(spark, d):
    """Orders with the text forms that cells carry; the money column as a plain decimal."""
    return table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), compact_day(F.col("o_orderdate")).alias("busi_date"))


_SLICE = """SELECT o_custkey, o_orderkey, o_custkey || '_' || o_orderkey AS rowkey, o_orderstatus,
    nullif(o_orderpriority, '5-LOW') AS priority, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
    strftime(o_orderdate, '%Y%m%d') AS busi_date FROM orders"""
_CELL = "SELECT rowkey, 'cf' AS family, '{c}' AS qualifier, CAST({c} AS VARCHAR) AS value FROM s WHERE {c} IS NOT NULL"
CELLS_SQL = f"WITH s AS ({_SLICE}) " + " UNION ALL ".join(
    _CELL.format(c=c) for c in ("o_custkey", "o_orderkey", "o_orderstatus", "priority", "o_totalprice", "busi_date"))


@query("rows_to_cells", CELLS_SQL)
def rows_to_cells_query(spark, d):
    return order_slice(spark, d).transform(rows_to_cells, ORDER_KEY)


@query("cells_to_wide", f"""
SELECT rowkey, o_orderstatus, priority, o_totalprice, CAST(busi_date AS BIGINT) AS busi_date FROM ({_SLICE})""")
def cells_to_wide_query(spark, d):
    cells = order_slice(spark, d).transform(rows_to_cells, ORDER_KEY)
    return cells_to_wide(cells, {"o_orderstatus": "string", "priority": "string", "o_totalprice": "decimal(18,2)",
                                 "busi_date": "bigint"})


@query("bulk_export_sorted", CELLS_SQL)
def bulk_export_sorted(spark, d):
    path = work_path(spark, "export")
    export_sorted(order_slice(spark, d).transform(rows_to_cells, ORDER_KEY), path)
    return spark.read.parquet(path)


@query("cells_key_range", CELLS_SQL.replace("FROM orders)", "FROM orders WHERE o_custkey || '_' || o_orderkey >= '10' "
                                            "AND o_custkey || '_' || o_orderkey < '12')"))
def cells_key_range(spark, d):
    """Range scan of the sorted export."""
    path = work_path(spark, "export")
    export_sorted(order_slice(spark, d).transform(rows_to_cells, ORDER_KEY), path)
    return key_range(spark.read.parquet(path), "10", "12")


_OLD = "o_orderdate < TIMESTAMP '1998-01-01'"


UPSERT_SQL = """
WITH c AS (
  SELECT o_custkey, 'o_orderstatus' AS qualifier, o_orderstatus AS value, o_orderdate, o_orderkey FROM orders
  UNION ALL SELECT o_custkey, 'priority', nullif(o_orderpriority, '5-LOW'), o_orderdate, o_orderkey FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS rowkey, 'cf' AS family, qualifier,
       arg_max(value, (o_orderdate, o_orderkey)) AS value
FROM c WHERE value IS NOT NULL GROUP BY o_custkey, qualifier"""


def order_cells(spark, d):
    """Two cells of every order under its customer's key, with the version columns."""
    wide = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("rowkey"), "o_orderdate", "o_orderkey", "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    cells = wide.unpivot(["rowkey", "o_orderdate", "o_orderkey"], ["o_orderstatus", "priority"], "qualifier", "value")
    return cells.where("value IS NOT NULL").withColumn("family", F.lit("cf"))


@query("keyed_upsert_ranges", UPSERT_SQL)
def keyed_upsert_ranges(spark, d):
    """Cells in key ranges: older orders, then later days in batches that are folded or merged on read."""
    cells, day = order_cells(spark, d), F.col("o_orderdate")
    cuts = [F.lit(x).cast("timestamp_ntz") for x in ("1998-01-01", "2000-01-01")]
    store = ranged_cell_store(work_path(spark, "ranges"), ["o_orderdate", "o_orderkey"], ranges=8)
    write, late = store.sink(), cells.where(day >= cuts[1])
    write(cells.where(day < cuts[0]), 0)
    store.compact(spark, 0)
    write(cells.where((day >= cuts[0]) & (day < cuts[1])), 1)
    write(late.where("rowkey < '2'"), 2)
    store.compact(spark, 2)
    for rows, batch_id in ((late.where("rowkey >= '2'"), 3), (cells.where(day < cuts[0]), 0), (late.where("rowkey < '2'"), 2)):
        write(rows, batch_id)
    return store.read(spark).select("rowkey", "family", "qualifier", "value")


@query("point_lookup", """
SELECT event_id, user_id, n_orders, last_order FROM events LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1) ON user_id = o_custkey""")
def point_lookup(spark, d):
    """Each batch of a day's events reads the buckets of its users from a store of order totals per customer."""
    totals = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    store = BucketStore(work_path(spark, "totals"), ["user_id"])
    store.create(totals, buckets=16)
    events, out = table(spark, d, "events").select("event_id", "user_id"), work_path(spark, "looked-up")
    sink = writers.batch_folder_sink(out, store.look_up)
    for i in range(3):
        sink(events.where(F.pmod(F.xxhash64("user_id"), F.lit(3)) == i), i)
    return writers.read_batches(spark, out).select("event_id", "user_id", "n_orders", "last_order")


@query("point_ledger", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def point_ledger(spark, d):
    """Keys that are looked up and stored if they are new, in batches of which one comes again."""
    events = table(spark, d, "events").select("user_id", "event_id").where("user_id IS NOT NULL")
    store = BucketStore(work_path(spark, "ledger"), ["user_id"])
    third = events.agg(F.max("event_id")).first()[0] // 3 + 1
    part = lambda i: events.where(F.floor(F.col("event_id") / third) == i)
    store.create(events.limit(0), buckets=16)
    for i in (0, 1, 1, 2):
        store.put_new(part(i))
    return spark.read.parquet(f"{store.path}/data").select("user_id", "event_id")


@query("input_files", "SELECT 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS n_rows, true AS listed FROM orders GROUP BY 1")
def input_files(spark, d):
    """Rows by the folder of the file that they come from, and whether the table's list of files names that folder."""
    path = work_path(spark, "orders-by-status")
    writers.write_partitioned(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, ["o_orderstatus"])
    return files.rows_per_folder(spark.read.parquet(path))


@query("keyed_upsert", """
WITH c AS (
  SELECT o_custkey, 'o_orderstatus' AS qualifier, o_orderstatus AS value, o_orderdate, o_orderkey FROM orders
  UNION ALL SELECT o_custkey, 'priority', nullif(o_orderpriority, '5-LOW'), o_orderdate, o_orderkey FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS rowkey, 'cf' AS family, qualifier,
       arg_max(value, (o_orderdate, o_orderkey)) AS value
FROM c WHERE value IS NOT NULL GROUP BY o_custkey, qualifier""")
def keyed_upsert_query(spark, d):
    """Older orders as the stored cells, newer ones merged in; a NULL never erases a stored value."""
    o = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    wide = o.select(F.col("o_custkey").cast("string").alias("rowkey"), "o_orderdate", "o_orderkey", "o_orderstatus", "priority")
    cells = wide.unpivot(["rowkey", "o_orderdate", "o_orderkey"], ["o_orderstatus", "priority"], "qualifier", "value")
    cells = cells.where("value IS NOT NULL").withColumn("family", F.lit("cf"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    old, new = cells.where(F.col("o_orderdate") < cut), cells.where(F.col("o_orderdate") >= cut)
    store = cell_store(work_path(spark, "cells"), ["o_orderdate", "o_orderkey"])
    write = store.sink()
    write(old, 0)
    store.compact(spark, 0)
    for rows, batch_id in ((new, 1), (new, 1), (old, 0)):  # batches that come again change nothing
        write(rows, batch_id)
    return store.read(spark).select("rowkey", "family", "qualifier", "value")


@query("keyed_rows", """
SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '_' || l_linenumber AS rowkey, 'cf' AS family, 'field' AS qualifier,
       CAST(l_quantity AS BIGINT)::VARCHAR AS value FROM lineitem""")
def keyed_rows(spark, d):
    """A cell of every line item under its zero-padded key, written as a sorted export."""
    key = joined_key(padded_key(F.col("l_orderkey")), F.col("l_linenumber"))
    cells = table(spark, d, "lineitem").select(key.alias("rowkey"), F.lit("cf").alias("family"), F.lit("field").alias("qualifier"),
                                               F.col("l_quantity").cast("bigint").cast("string").alias("value"))
    path = work_path(spark, "keyed")
    export_sorted(cells, path)
    return spark.read.parquet(path)


@query("salted_keys", "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS base, true AS well_formed FROM orders")
def salted_keys(spark, d):
    """Two salt digits below 99 in front of the padded key."""
    base = padded_key(F.col("o_orderkey"))
    o = table(spark, d, "orders").select("o_orderkey", base.alias("base"), salted_key(base).alias("salted"))
    ok = (F.substring("salted", 1, 2).cast("int").between(0, 98)) & (F.substring("salted", 3, 99) == F.col("base"))
    return o.select("o_orderkey", "base", ok.alias("well_formed"))


@query("rows_to_messages", """
SELECT 'orders' AS topic, o_custkey || '_' || o_orderkey AS key,
       '{"o_orderstatus":"' || o_orderstatus || '"' ||
       CASE WHEN o_orderpriority <> '5-LOW' THEN ',"priority":"' || o_orderpriority || '"' ELSE '' END || '}' AS value
FROM orders""")
def rows_to_messages(spark, d):
    rows = order_slice(spark, d).select(joined_key(F.col("o_custkey"), F.col("o_orderkey")).alias("key"), "o_orderstatus", "priority")
    return writers.to_messages(rows, "orders", "key")


# --- incremental reads -----------------------------------------------------------------------

OFFSET = "o_custkey * 1000000 + o_orderkey:long"


@query("offset_bounds", """
SELECT min(o_custkey * 1000000 + o_orderkey) AS min_offset, max(o_custkey * 1000000 + o_orderkey) AS max_offset FROM orders""")
def offset_bounds(spark, d):
    return incremental.offset_bounds(table(spark, d, "orders"), OFFSET)


@query("offset_slice_first", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey * 1000000 + o_orderkey >= (SELECT min(o_custkey * 1000000 + o_orderkey) FROM orders)
  AND o_custkey * 1000000 + o_orderkey <= 70000000""")
def offset_slice_first(spark, d):
    o = table(spark, d, "orders")
    low = incremental.offset_bounds(o, OFFSET).first()["min_offset"]
    return incremental.offset_slice(o, OFFSET, low, 70_000_000, inclusive=True).select("o_orderkey", "o_custkey")


@query("offset_slice_next", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey * 1000000 + o_orderkey > 70000000""")
def offset_slice_next(spark, d):
    o = table(spark, d, "orders")
    high = incremental.offset_bounds(o, OFFSET).first()["max_offset"]
    return incremental.offset_slice(o, OFFSET, 70_000_000, high, inclusive=False).select("o_orderkey", "o_custkey")
