"""Scalar functions, record parsing and user-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from millrace.functions import udfs
from millrace.functions.dates import compact_day, compact_day_via_unixtime, in_period, resolve_business_date
from millrace.functions.records import (LEDGER, LEDGER_JSON, TRADE, format_delimited, ledger_decimals, parse_delimited, parse_json,
                                        with_fallback)
from millrace.functions.text import lookup, null_to_empty, padded_key
from millrace.functions.types import cast_by_name
from millrace.sources.envelopes import decode, to_envelope
from millrace.sources.files import table
from millrace.workload.registry import query


@query("fn_math", """
SELECT c_custkey, abs(c_acctbal) AS abs_balance, c_custkey + 100 AS plus, c_custkey % 3 AS rest FROM customer""")
def fn_math(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", F.abs("c_acctbal").alias("abs_balance"), (F.col("c_custkey") + 100).alias("plus"),
        (F.col("c_custkey") % 3).alias("rest"))


@query("fn_string", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, reverse(p_name) AS reversed, p_brand || '_' || p_type AS joined,
       contains(p_name, 'ring') AS has_ring FROM part""")
def fn_string(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.reverse("p_name").alias("reversed"),
        F.concat_ws("_", "p_brand", "p_type").alias("joined"), F.contains("p_name", F.lit("ring")).alias("has_ring"))


@query("fn_null_to_empty", """
SELECT c_custkey, coalesce(CAST(nullif(c_nationkey, 7) AS VARCHAR), '') AS nation,
       reverse(trim(CAST(c_custkey AS VARCHAR))) AS reversed FROM customer""")
def fn_null_to_empty(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey", null_to_empty(F.nullif("c_nationkey", F.lit(7))).alias("nation"),
        F.reverse(null_to_empty(F.col("c_custkey"))).alias("reversed"))


@query("fn_date_compact", """
SELECT event_id, strftime(ts, '%Y%m%d') AS day, replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '') AS day_by_replace FROM events""")
def fn_date_compact(spark, d):
    return table(spark, d, "events").select(
        "event_id", compact_day(F.col("ts")).alias("day"),
        F.expr("replace(to_date(ts), '-', '')").alias("day_by_replace"))


@query("fn_unixtime", "SELECT event_id, strftime(ts, '%Y%m%d') AS day, CAST(epoch(CAST(ts AS DATE)) AS BIGINT) AS day_seconds FROM events")
def fn_unixtime(spark, d):
    return table(spark, d, "events").select(
        "event_id", compact_day_via_unixtime(F.col("ts")).alias("day"),
        F.unix_timestamp(F.to_date("ts")).alias("day_seconds"))


@query("fn_map_lookup", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' END AS label FROM orders""")
def fn_map_lookup(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", lookup({"O": "open", "F": "filled"}, F.col("o_orderstatus")).alias("label"))


@query("fn_cast_by_name", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(24,6)) AS price, CAST(o_orderkey AS INTEGER) AS key_int,
       CAST(o_orderdate AS DATE) AS day, TRY_CAST(o_orderpriority AS BIGINT) AS not_a_number FROM orders""")
def fn_cast_by_name(spark, d):
    text = lambda c: F.col(c).cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey", cast_by_name(text("o_totalprice"), "BigDecimal").alias("price"),
        cast_by_name(text("o_orderkey"), "integer").alias("key_int"),
        cast_by_name(F.date_format("o_orderdate", "yyyy-MM-dd"), "date").alias("day"),
        cast_by_name(F.col("o_orderpriority"), "long").alias("not_a_number"))


@query("json_parse", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
       CAST(NULL AS VARCHAR) AS missing FROM events""")
def json_parse(spark, d):
    """Broken text gives NULL fields, and so does a field that is not there."""
    text = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    return parse_json(table(spark, d, "events").select("event_id", text.alias("value")),
                      T.StructType([T.StructField("k", T.IntegerType()), T.StructField("missing", T.StringType())]))


@query("parse_with_default", """
SELECT CASE WHEN event_type = 'error' THEN 'Nil' ELSE event_type END AS name,
       CASE WHEN event_type = 'error' THEN 0 ELSE user_id END AS age,
       CASE WHEN event_type = 'error' THEN TIMESTAMP '1970-01-01' ELSE date_trunc('milliseconds', ts) END AS time FROM events""")
def parse_with_default(spark, d):
    """Lines ``name,age,epoch milliseconds``; one unreadable field replaces the whole record by the default."""
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    line = F.concat_ws(",", "event_type", "user_id", F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(millis))
    raw = parse_delimited(table(spark, d, "events").select(line.alias("value")),
                          T.StructType([T.StructField(n, T.StringType()) for n in ("name", "age", "ms")]))
    fields = {"name": F.col("name"), "age": F.col("age").try_cast("bigint"),
              "time": F.timestamp_millis(F.col("ms").try_cast("bigint")).cast("timestamp_ntz")}
    default = {"name": F.lit("Nil"), "age": F.lit(0).cast("bigint"),
               "time": F.lit("1970-01-01").cast("timestamp_ntz")}
    return raw.select(*with_fallback(fields, default))


def trade_lines(spark, d, *carried):
    """Line items as trade records, after carried columns."""
    return trade_texts(table(spark, d, "lineitem"), *carried)


def trade_texts(lineitem, *carried):
    """50-field trade records, after carried columns. Flags: N buys; A buys in kind; R sells, in two ways by line number."""
    flag = (F.when(F.col("l_returnflag") == "N", "03").when(F.col("l_returnflag") == "A", "0B")
            .when(F.col("l_linenumber") <= 4, "04").otherwise("0S"))
    values = {
        "serverid": F.lit("1"), "matchsno": F.col("l_orderkey"), "operdate": F.date_format("l_shipdate", "yyyyMMdd"),
        "custid": F.col("l_partkey"), "fundid": F.col("l_suppkey"), "moneytype": F.lit("0"), "orgid": F.lit("0001"),
        "secuid": F.concat(F.lit("A"), F.col("l_suppkey").cast("string")), "bsflag": flag,
        "matchtype": F.when(F.col("l_linestatus") == "O", "0").otherwise("1"), "market": F.col("l_linestatus"),
        "stkcode": padded_key(F.col("l_linenumber"), 6), "matchqty": F.col("l_quantity").cast("bigint"),
        "matchprice": F.col("l_discount").cast("decimal(12,2)"), "clearamt": F.col("l_extendedprice").cast("decimal(18,2)"),
        "matchamt": F.col("l_tax").cast("decimal(12,2)"), "trddate": F.date_format("l_shipdate", "yyyyMMdd"),
    }
    return lineitem.select(*carried, format_delimited(values, TRADE).alias("value"))


TRADE_SQL = """SELECT l_suppkey AS fundid, 'A' || l_suppkey AS secuid, '0001' AS orgid, l_linestatus AS market,
    lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS stkcode, 1 AS serverid,
    CASE WHEN l_returnflag = 'N' THEN '03' WHEN l_returnflag = 'A' THEN '0B' WHEN l_linenumber <= 4 THEN '04' ELSE '0S' END AS bsflag,
    CASE WHEN l_linestatus = 'O' THEN '0' ELSE '1' END AS matchtype, CAST(l_quantity AS BIGINT) AS matchqty,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS clearamt, l_orderkey AS matchsno,
    CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS trddate, '0' AS moneytype FROM lineitem"""


def ledger_lines(spark, d):
    """Orders as 82-field ledger records."""
    values = {
        "serverid": F.lit("1"), "bizdate": F.date_format("o_orderdate", "yyyyMMdd"), "sno": F.col("o_orderkey"),
        "custid": F.col("o_custkey"), "fundid": F.col("o_custkey"), "moneytype": F.lit("0"), "orgid": F.lit("0001"),
        "fundeffect": F.col("o_totalprice").cast("decimal(18,2)"), "busi_date": F.date_format("o_orderdate", "yyyyMMdd"),
        "remark": F.col("o_orderpriority"),
    }
    return table(spark, d, "orders").select(format_delimited(values, LEDGER).alias("value"))


@query("csv_record_parse", f"""
SELECT fundid, secuid, orgid, market, stkcode, CAST(serverid AS BIGINT) AS serverid, bsflag, matchtype, matchqty, clearamt,
       matchsno, trddate, CAST(NULL AS BIGINT) AS orderqty, '' AS remark FROM ({TRADE_SQL})""")
def csv_record_parse(spark, d):
    """50-field trade records; empty numbers are NULL, empty text stays empty."""
    parsed = trade_lines(spark, d).transform(parse_delimited, TRADE)
    return parsed.select("fundid", "secuid", "orgid", "market", "stkcode", "serverid", "bsflag", "matchtype", "matchqty",
                         F.col("clearamt").cast("decimal(18,2)").alias("clearamt"), "matchsno", "trddate", "orderqty", "remark")


@query("csv_ledger_parse", """
SELECT o_custkey AS fundid, '0001' AS orgid, o_orderkey AS sno, CAST(o_totalprice AS DECIMAL(18,2)) AS fundeffect,
       CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS bizdate, o_orderpriority AS remark,
       strftime(o_orderdate, '%Y%m%d') AS busi_date FROM orders""")
def csv_ledger_parse(spark, d):
    """82-field ledger records."""
    parsed = ledger_lines(spark, d).transform(parse_delimited, LEDGER)
    return parsed.select("fundid", "orgid", "sno", F.col("fundeffect").cast("decimal(18,2)").alias("fundeffect"), "bizdate",
                         "remark", "busi_date")


@query("json_ledger_decimals", """
SELECT o_orderkey AS sno, CAST(o_totalprice AS DECIMAL(19,2)) AS fundeffect, CAST(NULL AS DECIMAL(9,3)) AS orderprice
FROM orders""")
def json_ledger_decimals(spark, d):
    """Decimals that travel as text in the 83-field JSON record."""
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    value = F.to_json(F.struct(F.col("o_orderkey").alias("sno"), text.alias("fundeffect"), F.lit("n/a").alias("orderprice")))
    parsed = table(spark, d, "orders").select(value.alias("value")).transform(parse_json, LEDGER_JSON)
    return ledger_decimals(parsed).select(F.col("sno").cast("bigint").alias("sno"), "fundeffect", "orderprice")


@query("envelope_decode", """
SELECT CAST(user_id AS VARCHAR) AS message_key, ts AS message_time, event_id, event_type, props FROM events""")
def envelope_decode(spark, d):
    messages = to_envelope(table(spark, d, "events"), "user_id", "ts", "event_id", "event_type", "props")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("props", T.StringType())])
    return decode(messages, schema).withColumn("message_time", F.col("message_time").cast("timestamp_ntz"))


# --- user-defined functions ------------------------------------------------------------------


@query("udf_hello", """
SELECT c_custkey, 'hello ' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') AS greeting,
       'hello ' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') AS greeting_native FROM customer""")
def udf_hello(spark, d):
    udfs.register_functions(spark)
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return c.select("c_custkey", F.call_udf("hello", "segment").alias("greeting"),
                    udfs.hello(F.col("segment")).alias("greeting_native"))


@query("udaf_avg_sql", """
SELECT c_nationkey, round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END), 4) AS average
FROM customer GROUP BY 1""")
def udaf_avg_sql(spark, d):
    udfs.register_functions(spark)
    c = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("x"))
    c.createOrReplaceTempView("mr_balances")
    return spark.sql("SELECT c_nationkey, round(average, 4) AS average FROM ("
                     "SELECT c_nationkey, my_average(sum(x), count(x)) AS average FROM mr_balances GROUP BY c_nationkey)")


@query("udaf_avg_partial_merge", """
SELECT o_orderstatus, round(avg(o_totalprice), 4) AS average FROM orders GROUP BY 1""")
def udaf_avg_partial_merge(spark, d):
    merged = udfs.mergeable_average(table(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", "average", ["o_orderpriority"])
    return merged.select("o_orderstatus", F.round("average", 4).alias("average"))


@query("udaf_user_code", """
SELECT c_nationkey, round(avg(c_acctbal), 4) AS average FROM customer GROUP BY 1""")
def udaf_user_code(spark, d):
    """Average in Python: reduce to (total, n), merge by adding, finish by dividing."""
    def reduce(rows):
        return rows.groupby("c_nationkey", as_index=False).agg(total=("c_acctbal", "sum"), n=("c_acctbal", "count"))

    def merge(buffers):
        return buffers.groupby("c_nationkey", as_index=False)[["total", "n"]].sum()

    def finish(buffers):
        return buffers["total"] / buffers["n"]

    c = table(spark, d, "customer").select("c_nationkey", "c_acctbal")
    out = udfs.user_aggregate(c, ["c_nationkey"], "total DOUBLE, n BIGINT", "DOUBLE", reduce, merge, finish, "average")
    return out.withColumn("average", F.round("average", 4))


@query("udaf_empty_groups", """
SELECT c_nationkey, count(*) AS n, CAST(NULL AS DOUBLE) AS average FROM customer GROUP BY 1""")
def udaf_empty_groups(spark, d):
    """The average of nothing is NULL, however many rows a group has."""
    c = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_acctbal") < -1e9, F.col("c_acctbal")).alias("x"))
    state = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), udfs.avg_state(F.col("x")).alias("state"))
    return state.select("c_nationkey", "n", udfs.finish_avg(F.col("state")).alias("average"))


@query("business_periods", """
SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n, count(*) FILTER (strftime(o_orderdate, '%Y%m') = '199603') AS in_month,
       count(*) FILTER (strftime(o_orderdate, '%Y') = '1996') AS in_year FROM orders GROUP BY 1""")
def business_periods(spark, d):
    """Days as text, and the days of a month and of a year by period bounds."""
    o, day = table(spark, d, "orders"), F.col("o_orderdate")
    return o.groupBy(compact_day(day).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(in_period(day, "199603")).alias("in_month"), F.count_if(in_period(day, "1996")).alias("in_year"))


@query("job_dates", """
WITH d AS (SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1),
j AS (SELECT 'configured' AS given, strftime(max(o_orderdate), '%Y%m%d') AS day FROM orders
      UNION ALL SELECT 'scheduled', strftime(min(o_orderdate), '%Y%m%d') FROM orders
      UNION ALL SELECT 'neither', strftime(max(o_orderdate) - INTERVAL 1 DAY, '%Y%m%d') FROM orders)
SELECT given, j.day, coalesce(n, 0) AS n FROM j LEFT JOIN d ON d.day = j.day""")
def job_dates(spark, d):
    """Orders of a job's day: the configured one, else that of the scheduler's stamp, else the day before today (here, the last day)."""
    o = table(spark, d, "orders")
    first, last = o.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    stamp, day = f"{first:%Y%m%d}0300", f"{last:%Y%m%d}"
    jobs = spark.createDataFrame([("configured", resolve_business_date(day, stamp, last.date())), ("scheduled", resolve_business_date(None, stamp, last.date())),
                                  ("neither", resolve_business_date(None, None, last.date()))], "given STRING, day STRING")
    counted = o.groupBy(compact_day(F.col("o_orderdate")).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return jobs.join(counted, "day", "left").select("given", "day", F.coalesce("n", F.lit(0)).alias("n"))


@query("map_in_pandas", """
SELECT event_id, upper(event_type) AS kind, value * 2 AS doubled FROM events WHERE value > 10""")
def map_in_pandas(spark, d):
    """Filter, map and extend rows in Arrow batches."""
    def rows(batches):
        for pdf in batches:
            kept = pdf[pdf["value"] > 10]
            yield kept.assign(kind=kept["event_type"].str.upper(), doubled=kept["value"] * 2)[["event_id", "kind", "doubled"]]

    return table(spark, d, "events").select("event_id", "event_type", "value").mapInPandas(
        rows, "event_id BIGINT, kind STRING, doubled DOUBLE")
