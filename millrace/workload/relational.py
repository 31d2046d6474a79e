"""Projections, filters, joins, aggregates, set operations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.functions.records import non_null_map, row_json
from millrace.functions.text import sorted_set
from millrace.functions.types import conform
from millrace.operators import aggregates, joins
from millrace.operators.cells import slice_by_day
from millrace.operators.ordered import with_position
from millrace.operators.theta import theta_join
from millrace.sources.files import table
from millrace.workload.registry import query

# --- projections -----------------------------------------------------------------------------


@query("project_arith", """
SELECT o_orderkey, o_orderkey + 100 AS key_plus, round(o_totalprice + 1, 2) AS price_plus FROM orders""")
def project_arith(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderkey") + 100).alias("key_plus"), F.round(F.col("o_totalprice") + 1, 2).alias("price_plus"))


@query("select_expr", "SELECT c_custkey, c_name AS new_name, abs(c_acctbal) AS abs_balance FROM customer")
def select_expr(spark, d):
    return table(spark, d, "customer").selectExpr("c_custkey", "c_name AS new_name", "abs(c_acctbal) AS abs_balance")


@query("join_alias_project", """
SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_alias_project(spark, d):
    o, c = table(spark, d, "orders").alias("o"), table(spark, d, "customer").alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey")).selectExpr("o.o_orderkey", "c.c_name", "c.c_mktsegment")


@query("with_column_replace", """
SELECT o_orderkey + 1 AS o_orderkey, o_custkey, o_orderkey AS key_copy FROM orders""")
def with_column_replace(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return o.withColumn("key_copy", F.col("o_orderkey")).withColumn("o_orderkey", F.col("o_orderkey") + 1)


@query("rename_drop", "SELECT c_custkey, c_name AS name1, c_nationkey FROM customer")
def rename_drop(spark, d):
    return table(spark, d, "customer").withColumnRenamed("c_name", "name1").drop("c_acctbal", "c_mktsegment")


@query("to_df_names", "SELECT p_partkey AS id, p_name AS name, p_brand AS brand, p_size AS size FROM part")
def to_df_names(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size").toDF("id", "name", "brand", "size")


@query("conform_schema", """
SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer""")
def conform_schema(spark, d):
    schema = T.StructType([
        T.StructField("c_mktsegment", T.StringType()), T.StructField("c_nationkey", T.LongType()),
        T.StructField("c_custkey", T.LongType()), T.StructField("note", T.StringType())])
    return conform(table(spark, d, "customer"), schema)


@query("map_rows", """
SELECT c_custkey + 10 AS shifted, 'Name: ' || c_name AS named,
       'Key: ' || c_custkey || ', Value: ' || c_mktsegment AS pair FROM customer""")
def map_rows(spark, d):
    return table(spark, d, "customer").select(
        (F.col("c_custkey") + 10).alias("shifted"), F.concat(F.lit("Name: "), "c_name").alias("named"),
        F.format_string("Key: %d, Value: %s", "c_custkey", "c_mktsegment").alias("pair"))


@query("transform_chain", """
SELECT o_custkey || '_' || o_orderkey AS key, round(o_totalprice * 2, 2) AS doubled FROM orders WHERE o_orderstatus = 'F'""")
def transform_chain(spark, d):
    """Whole-frame functions, one after the other."""
    def finished(df):
        return df.where("o_orderstatus = 'F'")

    def keyed(df, *keys):
        return df.withColumn("key", F.concat_ws("_", *keys))

    return (table(spark, d, "orders").transform(finished).transform(keyed, "o_custkey", "o_orderkey")
            .select("key", F.round(F.col("o_totalprice") * 2, 2).alias("doubled")))


@query("hash_layout", "SELECT o_custkey, count(*) AS n, 1 AS partitions FROM orders GROUP BY 1")
def hash_layout(spark, d):
    """After a repartition by key, all rows of a key are in one partition."""
    laid = table(spark, d, "orders").repartition("o_custkey").select("o_custkey", F.spark_partition_id().alias("part"))
    return laid.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("part").cast("int").alias("partitions"))


@query("flatmap_words", "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents")
def flatmap_words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))


@query("explode_keep_all", "SELECT *, unnest(string_split(p_name, ' ')) AS exp FROM part")
def explode_keep_all(spark, d):
    return table(spark, d, "part").select("*", F.explode(F.split("p_name", " ")).alias("exp"))


@query("json_struct_expand", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_struct_expand(spark, d):
    parsed = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k INT").alias("j"))
    return parsed.select("event_id", "event_type", "j.*")


@query("rows_to_json", """
SELECT CAST(to_json({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus, 'o_orderpriority': o_orderpriority})
            AS VARCHAR) AS json FROM orders""")
def rows_to_json(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").select(row_json().alias("json"))


@query("row_to_map", """
SELECT c_custkey, 'c_name' AS field, c_name AS text FROM customer
UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def row_to_map(spark, d):
    c = table(spark, d, "customer").withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return c.select("c_custkey", F.explode(non_null_map("c_name", "c_nationkey", "segment")).alias("field", "text"))


# --- filters ---------------------------------------------------------------------------------


@query("filter_compare", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'O'")
def filter_compare(spark, d):
    return table(spark, d, "orders").filter("o_totalprice > 200000").where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", "o_totalprice")


@query("filter_between", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def filter_between(spark, d):
    return table(spark, d, "part").where(F.col("p_size").between(13, 19)).select("p_partkey", "p_name", "p_size")


@query("filter_fn", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5")
def filter_fn(spark, d):
    below = lambda col, limit: col < limit
    return table(spark, d, "lineitem").where(below(F.col("l_quantity"), 5)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_isin", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_isin(spark, d):
    wanted = ["1-URGENT", "2-HIGH"]
    return table(spark, d, "orders").where(F.col("o_orderpriority").isin(wanted)).select("o_orderkey", "o_orderpriority")


@query("filter_compound", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE l_returnflag IN ('R', 'A') OR l_linestatus = 'O'""")
def filter_compound(spark, d):
    return table(spark, d, "lineitem").where("l_returnflag IN ('R', 'A') OR l_linestatus = 'O'").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


@query("filter_nulls", """
SELECT nullif(c_mktsegment, 'BUILDING') IS NULL AS no_segment, count(*) AS n FROM customer GROUP BY 1""")
def filter_nulls(spark, d):
    c = table(spark, d, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    missing, present = c.where(F.col("segment").isNull()), c.where(F.col("segment").isNotNull())
    count = lambda df, flag: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(flag).alias("no_segment"), "n")
    return count(missing, True).union(count(present, False))


@query("filter_not_equal", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def filter_not_equal(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus")


@query("filter_null_safe", """
SELECT c_name FROM customer WHERE coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END > 3000, false)""")
def filter_null_safe(spark, d):
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return table(spark, d, "customer").where(F.coalesce(balance > 3000, F.lit(False))).select("c_name")


@query("filter_mixed_type_in", """
SELECT c_custkey, c_nationkey FROM customer WHERE CAST(c_nationkey AS VARCHAR) IN ('3', '7', '11', '19')""")
def filter_mixed_type_in(spark, d):
    c = table(spark, d, "customer")
    codes = [F.lit(code).cast(c.schema["c_nationkey"].dataType) for code in ("3", "7", "11", "19")]
    return c.where(F.col("c_nationkey").isin(codes)).select("c_custkey", "c_nationkey")


@query("day_slice", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate = TIMESTAMP '1996-03-06 00:00:00'""")
def day_slice(spark, d):
    return table(spark, d, "orders").transform(slice_by_day, "o_orderdate", "1996-03-06").select(
        "o_orderkey", "o_custkey", "o_orderstatus")


@query("day_slice_full", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def day_slice_full(spark, d):
    return table(spark, d, "orders").transform(slice_by_day, "o_orderdate", "-1").select(
        "o_orderkey", "o_custkey", "o_orderstatus")


# --- joins -----------------------------------------------------------------------------------


def _orders(spark, d):
    return table(spark, d, "orders").withColumnRenamed("o_custkey", "custkey")


def _customers(spark, d):
    return table(spark, d, "customer").withColumnRenamed("c_custkey", "custkey")


@query("join_inner", """
SELECT custkey, o_orderkey, c_name FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders)
JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)""")
def join_inner(spark, d):
    return _orders(spark, d).join(_customers(spark, d), ["custkey"], "inner").select("custkey", "o_orderkey", "c_name")


@query("join_left", """
SELECT c_custkey AS custkey, c_name, o_orderkey FROM customer
LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON o_custkey = c_custkey""")
def join_left(spark, d):
    pending = _orders(spark, d).where("o_orderstatus = 'P'")
    return _customers(spark, d).join(pending, ["custkey"], "leftouter").select("custkey", "c_name", "o_orderkey")


@query("join_right", """
SELECT o_custkey AS custkey, o_orderkey, c_name FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')
RIGHT JOIN orders ON o_custkey = c_custkey""")
def join_right(spark, d):
    building = _customers(spark, d).where("c_mktsegment = 'BUILDING'")
    return building.join(_orders(spark, d), ["custkey"], "rightouter").select("custkey", "o_orderkey", "c_name")


@query("join_cross", "SELECT c_custkey, r_name FROM customer CROSS JOIN region")
def join_cross(spark, d):
    small = joins.lookup(table(spark, d, "region").select("r_name"))
    return table(spark, d, "customer").select("c_custkey").crossJoin(small)


@query("join_theta_pairs", """
SELECT c_custkey, c_name, r_regionkey, r_name FROM customer LEFT JOIN region ON c_custkey > 1 AND c_nationkey < r_regionkey""")
def join_theta_pairs(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    pairs = joins.join_pairs(c, table(spark, d, "region"), (F.col("l.c_custkey") > 1) & (F.col("l.c_nationkey") < F.col("r.r_regionkey")))
    return pairs.select("l.c_custkey", "l.c_name", "r.r_regionkey", "r.r_name")


@query("join_theta_large", """
SELECT event_id, o_orderkey, spent, o_totalprice FROM (
  SELECT event_id, value * 100 AS spent, CAST(epoch_us(ts) // 1000000 AS BIGINT) % 86400 AS clock FROM events) e
LEFT JOIN (SELECT o_orderkey, o_totalprice, o_orderkey % 86400 AS slot FROM orders) o ON spent > o_totalprice AND clock < slot""")
def join_theta_large(spark, d):
    """Two large sides that only inequalities connect; events without a match stay."""
    e = table(spark, d, "events").select("event_id", (F.col("value") * 100).alias("spent"),
                                         (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000) % 86400).alias("clock"))
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % 86400).alias("slot"))
    return theta_join(e, o, [("spent", ">", "o_totalprice"), ("clock", "<", "slot")]).select(
        "l.event_id", "r.o_orderkey", "l.spent", "r.o_totalprice")


@query("sort_positions", """
SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (
    ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_extendedprice) AS position FROM lineitem""")
def sort_positions(spark, d):
    """The place of every line item in one order over all of them."""
    l = table(spark, d, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return with_position(l, [F.desc("l_shipdate"), "l_orderkey", "l_linenumber", "l_extendedprice"])


@query("join_broadcast", """
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_broadcast(spark, d):
    lookup = joins.lookup(table(spark, d, "nation").select("n_nationkey", "n_name"))
    return table(spark, d, "customer").join(lookup, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("join_broadcast_sql", """
SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def join_broadcast_sql(spark, d):
    """SQL text over lookup views, which carry the hint and hold their declared size."""
    for name in ("nation", "region"):
        joins.lookup(table(spark, d, name)).createOrReplaceTempView(f"mr_{name}")
    table(spark, d, "supplier").createOrReplaceTempView("mr_supplier")
    return spark.sql("SELECT s_suppkey, n_name, r_name FROM mr_supplier JOIN mr_nation ON s_nationkey = n_nationkey "
                     "JOIN mr_region ON n_regionkey = r_regionkey")


@query("join_multi_key", """
SELECT e.event_id, e.user_id, e.event_type, l.later FROM events e JOIN (
    SELECT user_id, event_type, count(*) AS later FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2) l
ON e.user_id = l.user_id AND e.event_type = l.event_type WHERE e.ts < TIMESTAMP '2024-01-15'""")
def join_multi_key(spark, d):
    e, cut = table(spark, d, "events"), F.lit("2024-01-15").cast("timestamp_ntz")
    later = e.where(F.col("ts") >= cut).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("later"))
    early = e.where(F.col("ts") < cut).select("event_id", "user_id", "event_type")
    return early.join(later, ["user_id", "event_type"]).select("event_id", "user_id", "event_type", "later")


@query("join_on_both_keys", """
SELECT o.o_custkey, c.c_custkey, o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_on_both_keys(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("mr_orders")
    table(spark, d, "customer").createOrReplaceTempView("mr_customer")
    return spark.sql("SELECT o.o_custkey, c.c_custkey, o.o_orderkey, c.c_nationkey "
                     "FROM mr_orders o JOIN mr_customer c ON o.o_custkey = c.c_custkey")


@query("join_trimmed_keys", """
SELECT s_suppkey, n_name AS name, b.n_regionkey FROM supplier JOIN nation b ON s_nationkey = n_nationkey""")
def join_trimmed_keys(spark, d):
    n = table(spark, d, "nation")
    padded = n.select("n_nationkey", F.rpad("n_name", 25, " ").alias("name"))
    left = table(spark, d, "supplier").join(padded, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "name")
    return joins.join_trimmed(left, n.select(F.col("n_name").alias("name"), "n_regionkey"), ["name"]).select(
        "s_suppkey", "name", "n_regionkey")


@query("join_cross_type", """
SELECT CAST(c_custkey AS VARCHAR) AS cust_id, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey""")
def join_cross_type(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("cust_id"))
    o = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("cust_id"), "o_orderkey")
    return c.join(o, "cust_id").select("cust_id", "o_orderkey")


@query("join_left_anti", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
    SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01')""")
def join_left_anti(spark, d):
    done = _orders(spark, d).where((F.col("o_orderstatus") == "F")
                                   & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")))
    return joins.drop_matching(_customers(spark, d), done, ["custkey"]).select(F.col("custkey").alias("c_custkey"), "c_name")


@query("join_left_semi_residual", """
SELECT DISTINCT o_custkey AS custkey FROM orders a WHERE o_orderstatus = 'O' AND EXISTS (
    SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderstatus = 'F'
    AND b.o_orderpriority <> a.o_orderpriority)""")
def join_left_semi_residual(spark, d):
    o = _orders(spark, d).select("custkey", "o_orderstatus", "o_orderpriority")
    opened, done = o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'")
    return joins.semi_with_difference(opened, done, "custkey", "o_orderpriority").select("custkey").distinct()


@query("join_left_semi", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (
    SELECT user_id FROM events WHERE event_type = 'purchase'
    UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""")
def join_left_semi(spark, d):
    buyers = table(spark, d, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("custkey"))
    urgent = _orders(spark, d).where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select("custkey")
    return joins.keep_matching(_customers(spark, d), buyers.union(urgent), ["custkey"]).select(
        F.col("custkey").alias("c_custkey"), "c_name")


@query("join_multiway", """
SELECT n_name, count(*) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' AND c_mktsegment = 'BUILDING' GROUP BY n_name""")
def join_multiway(spark, d):
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    buyers = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")
    wanted = o.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")
    l = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    return l.join(wanted, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("price").alias("revenue"))


@query("join_self", """
SELECT a.o_orderkey, a.o_custkey AS custkey, b.n_done, b.last_done FROM orders a LEFT JOIN (
    SELECT o_custkey, count(*) AS n_done, max(o_orderdate) AS last_done FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW' GROUP BY 1) b ON a.o_custkey = b.o_custkey
WHERE a.o_orderstatus = 'O' AND a.o_orderpriority = '1-URGENT'""")
def join_self(spark, d):
    o = _orders(spark, d)
    done = o.where("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'").groupBy("custkey").agg(
        F.count(F.lit(1)).alias("n_done"), F.max("o_orderdate").alias("last_done"))
    a = o.where("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'").select("o_orderkey", "custkey")
    return a.join(done, "custkey", "left").select("o_orderkey", "custkey", "n_done", "last_done")


@query("join_salted", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def join_salted(spark, d):
    c = _customers(spark, d).select("custkey", "c_name", "c_mktsegment")
    return joins.salted_join(_orders(spark, d).select("custkey", "o_orderkey"), c, ["custkey"], salts=4, how="left",
                             spread_by=["o_orderkey"]).select("o_orderkey", "c_name", "c_mktsegment")


@query("interval_join", """
SELECT a.event_id AS click_id, b.event_id AS view_id, a.user_id
FROM (SELECT * FROM events WHERE event_type = 'click') a
LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') b
ON a.user_id = b.user_id AND a.ts >= b.ts AND a.ts < b.ts + INTERVAL 6 HOURS""")
def interval_join(spark, d):
    e = table(spark, d, "events")
    clicks = e.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("t1"))
    views = e.where("event_type = 'view'").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), F.col("ts").alias("t2"))
    return joins.interval_join(clicks, views, ("user_id", "viewer"), ("t1", "t2"), 6 * 3600, "left").select(
        "click_id", "view_id", "user_id")


# --- aggregates ------------------------------------------------------------------------------


@query("agg_count", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_count(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("agg_mean_multi", """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_quantity, round(avg(l_discount), 6) AS avg_discount
FROM lineitem GROUP BY 1, 2""")
def agg_mean_multi(spark, d):
    means = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").mean("l_quantity", "l_discount")
    return means.select("l_returnflag", "l_linestatus", F.round("avg(l_quantity)", 6).alias("avg_quantity"),
                        F.round("avg(l_discount)", 6).alias("avg_discount"))


@query("agg_map_spec", "SELECT o_orderstatus, max(o_totalprice) AS max_price FROM orders GROUP BY 1")
def agg_map_spec(spark, d):
    spec = dict([("o_totalprice", "avg"), ("o_totalprice", "max")])  # a repeated column keeps its last function
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(spec).withColumnRenamed("max(o_totalprice)", "max_price")


@query("agg_pair_spec", """
SELECT o_orderstatus, min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice,
       count(o_orderkey) AS count_o_orderkey FROM orders GROUP BY 1""")
def agg_pair_spec(spark, d):
    return aggregates.agg_pairs(table(spark, d, "orders"), ["o_orderstatus"],
                                [("o_totalprice", "min"), ("o_totalprice", "max"), ("o_orderkey", "count")])


@query("agg_expr", """
SELECT o_orderstatus, o_orderpriority, o_orderstatus AS status_again, count(*) AS n, max(o_orderkey) + 1000 AS max_key
FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def agg_expr(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.col("o_orderstatus").alias("status_again"), F.count("*").alias("n"),
        (F.max("o_orderkey") + 1000).alias("max_key"))


@query("agg_global", "SELECT count(*) AS n, max(l_quantity) + 1000 AS max_quantity FROM lineitem")
def agg_global(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), (F.max("l_quantity") + 1000).alias("max_quantity"))


@query("agg_pivot", """
SELECT l_returnflag, round(avg(l_quantity) FILTER (l_linestatus = 'F'), 6) AS F,
       round(avg(l_quantity) FILTER (l_linestatus = 'O'), 6) AS O FROM lineitem GROUP BY 1""")
def agg_pivot(spark, d):
    wide = table(spark, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus").avg("l_quantity")
    return wide.select("l_returnflag", F.round("F", 6).alias("F"), F.round("O", 6).alias("O"))


@query("agg_rollup", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS max_price
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def agg_rollup(spark, d):
    return table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("max_price"))


@query("agg_cube", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS max_price
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def agg_cube(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("max_price"))


@query("agg_derived_key", "SELECT o_orderkey % 3 AS remainder, count(*) AS n FROM orders GROUP BY 1")
def agg_derived_key(spark, d):
    return table(spark, d, "orders").groupBy((F.col("o_orderkey") % 3).alias("remainder")).agg(F.count("*").alias("n"))


@query("agg_avg_by_key", "SELECT user_id, round(avg(value), 6) AS avg_value FROM events GROUP BY 1")
def agg_avg_by_key(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("avg_value"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("dedup_first_by", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def dedup_first_by(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return aggregates.first_by(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("agg_string_set", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM orders GROUP BY 1""")
def agg_string_set(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(sorted_set(F.col("o_orderstatus")).alias("statuses"))


# --- duplicates, sorts, limits ---------------------------------------------------------------


@query("row_number_multiset", """
SELECT l_returnflag, l_linestatus, l_linenumber,
       row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_linenumber) AS copy_no FROM lineitem""")
def row_number_multiset(spark, d):
    return aggregates.number_duplicates(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("sort_limit", """
SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders ORDER BY o_orderpriority DESC, o_totalprice DESC, o_orderkey
LIMIT 100""")
def sort_limit(spark, d):
    return table(spark, d, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey").sort(
        F.desc("o_orderpriority"), F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("top_k", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def top_k(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").orderBy(
        F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey").limit(10)


# --- set operations --------------------------------------------------------------------------


@query("union_all_pos", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_all_pos(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return c.union(table(spark, d, "supplier").select("s_suppkey", "s_name"))


@query("union_by_name", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return c.unionByName(table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


def _halves(spark, d):
    """All orders on two sides: before 1997, and from then on or without a date."""
    early = F.coalesce(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"), F.lit(False))
    o = table(spark, d, "orders")
    return [o.where(side).select("o_custkey", "o_orderstatus") for side in (early, ~early)]


_EARLY = "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'"
_LATE = "SELECT o_custkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderdate < TIMESTAMP '1997-01-01', false)"


@query("intersect_distinct", f"{_EARLY} INTERSECT {_LATE}")
def intersect_distinct(spark, d):
    return aggregates.intersect_rows(*_halves(spark, d))


@query("intersect_all", f"{_EARLY} INTERSECT ALL {_LATE}")
def intersect_all(spark, d):
    return aggregates.intersect_multiset(*_halves(spark, d))


@query("except_distinct", f"{_EARLY} EXCEPT {_LATE}")
def except_distinct(spark, d):
    return aggregates.except_rows(*_halves(spark, d))


@query("except_all", f"{_EARLY} EXCEPT ALL {_LATE}")
def except_all(spark, d):
    return aggregates.except_multiset(*_halves(spark, d))


@query("union_distinct", f"{_EARLY} UNION {_LATE}")
def union_distinct(spark, d):
    a, b = _halves(spark, d)
    return a.union(b).distinct()
