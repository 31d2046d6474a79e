"""Statistics, sketches, sampling, null handling and sessions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from millrace.operators import sampling, sessions, statistics as st
from millrace.session import materialize
from millrace.sources.files import table
from millrace.workload.registry import query

PROBS = (0.25, 0.5, 0.9)


@query("stat_quantile_exact", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, round(quantile_cont(l_extendedprice, {p}), 4) AS value FROM lineitem" for p in PROBS))
def stat_quantile_exact(spark, d):
    found = st.exact_quantiles(table(spark, d, "lineitem"), "l_extendedprice", PROBS)
    return spark.createDataFrame([(p, float(v)) for p, v in found.items()], "prob DOUBLE, value DOUBLE").select(
        "prob", F.round("value", 4).alias("value"))


@query("stat_quantile_approx", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, true AS within_error" for p in PROBS))
def stat_quantile_approx(spark, d):
    """Rank of each approximate quantile, checked against the promised error."""
    l, error = table(spark, d, "lineitem"), 0.01
    found = st.approx_quantiles(l, "l_extendedprice", PROBS, error).collect()  # one row per probability
    x = F.col("l_extendedprice")
    ok = [(F.avg((x < r.value).cast("int")) <= r.prob + error) & (F.avg((x <= r.value).cast("int")) >= r.prob - error)
          for r in found]
    checks = F.array(*[F.struct(F.lit(r.prob).alias("prob"), c.alias("within_error")) for r, c in zip(found, ok)])
    return l.agg(checks.alias("checks")).select(F.inline("checks"))


@query("stat_quantile_merge", " UNION ALL ".join(
    f"""SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, CAST({p} AS DOUBLE) AS prob, count(*) AS n, true AS within_error
        FROM lineitem GROUP BY 1, 2""" for p in PROBS))
def stat_quantile_merge(spark, d):
    """Quantiles per flag and year from stored sketches of single days; ranks are checked against all rows."""
    l, error = table(spark, d, "lineitem"), 0.01
    rows = l.select("l_returnflag", F.to_date("l_shipdate").alias("day"), F.col("l_extendedprice").alias("x"))
    stored = materialize(st.value_sketches(rows, "x", ["l_returnflag", "day"]), "sketches")
    year = F.year("day").alias("year")
    found = st.merged_quantiles(stored.withColumn("year", year), ["l_returnflag", "year"], PROBS)
    # One row per flag and year on this side, with all its quantiles.
    wide = found.groupBy("l_returnflag", "year").agg(F.map_from_entries(F.collect_list(F.struct("prob", "value"))).alias("q"), F.max("n").alias("n"))
    value = {p: F.element_at("q", F.lit(p)) for p in PROBS}
    ranks = rows.withColumn("year", year).join(wide, ["l_returnflag", "year"]).groupBy("l_returnflag", "year", "n").agg(F.array(*[
        F.struct(F.lit(p).alias("prob"), ((F.avg((F.col("x") < v).cast("int")) <= p + error)
                                          & (F.avg((F.col("x") <= v).cast("int")) >= p - error)).alias("within_error"))
        for p, v in value.items()]).alias("checks"))
    return ranks.select("l_returnflag", "year", "n", F.inline("checks"))


@query("stat_cov", "SELECT round(covar_samp(l_quantity, l_extendedprice), 2) AS cov FROM lineitem")
def stat_cov(spark, d):
    return table(spark, d, "lineitem").agg(F.round(F.covar_samp("l_quantity", "l_extendedprice"), 2).alias("cov"))


@query("stat_corr", "SELECT round(corr(l_quantity, l_extendedprice), 8) AS corr FROM lineitem")
def stat_corr(spark, d):
    return table(spark, d, "lineitem").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 8).alias("corr"))


@query("stat_freq_items", """
SELECT event_type, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 0.15 * (SELECT count(*) FROM events)""")
def stat_freq_items(spark, d):
    return st.frequent_items(table(spark, d, "events"), "event_type", 0.15)


@query("stat_freq_items_nulls", """
WITH o AS (SELECT nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus FROM orders)
SELECT 'priority' AS "column", priority AS value, count(*) AS n FROM o GROUP BY 2 HAVING count(*) >= 0.1 * (SELECT count(*) FROM o)
UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM o GROUP BY 2 HAVING count(*) >= 0.1 * (SELECT count(*) FROM o)""")
def stat_freq_items_nulls(spark, d):
    """Two columns at once, one with NULL as a frequent value."""
    o = table(spark, d, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), "o_orderstatus")
    return st.frequent_items_of(o, ["priority", "o_orderstatus"], 0.1)


@query("stat_bloom_prefilter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (
    SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""")
def stat_bloom_prefilter(spark, d):
    """Bloom filter of the wanted keys thins the big side before the exact semi-join."""
    wanted = table(spark, d, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select("o_orderkey")
    expected = wanted.count()
    bloom = st.bloom_build(wanted, "o_orderkey", expected)
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    thin = st.bloom_filter(l, "l_orderkey", bloom, expected)
    return thin.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


@query("stat_cms", """
SELECT l_suppkey, count(*) AS n, true AS never_below, true AS near FROM lineitem GROUP BY 1""")
def stat_cms(spark, d):
    """Count-min estimates next to the true counts: never below, and above by at most the sketch's bound.

    The bound is e / 2^14 of the rows for every supplier, so the sketch is sized by the number of suppliers.
    """
    l, error = table(spark, d, "lineitem"), math.e / (1 << 14)
    true = materialize(l.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")), "true-counts")
    rows, items = true.agg(F.sum("n"), F.count(F.lit(1))).first()
    depth, width = st.cms_shape(error, items)
    cells = st.cms_build(l, "l_suppkey", depth, width)
    estimates = st.cms_estimate(true, "l_suppkey", cells, depth, width).withColumnRenamed("l_suppkey", "_item")
    bound = (rows or 0) * error
    return true.join(estimates, F.col("l_suppkey").eqNullSafe(F.col("_item"))).select(
        "l_suppkey", "n", (F.col("estimate") >= F.col("n")).alias("never_below"),
        (F.col("estimate") <= F.col("n") + bound).alias("near"))


@query("stat_crosstab", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
       count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def stat_crosstab(spark, d):
    return st.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


_DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS n, round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS stddev,
    CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max{p} FROM customer"""


def _rounded(df):
    return df.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("stat_describe", _DESCRIBE.format(c="c_custkey", x="c_custkey", p="") + " UNION ALL "
       + _DESCRIBE.format(c="c_acctbal", x="c_acctbal", p="") + " UNION ALL "
       + _DESCRIBE.format(c="c_name", x="CAST(NULL AS DOUBLE)", p=""))
def stat_describe(spark, d):
    return _rounded(st.describe_long(table(spark, d, "customer"), ["c_custkey", "c_acctbal", "c_name"]))


_QUARTILES = ", " + ", ".join("round(quantile_cont(CAST({x} AS DOUBLE), 0." + q + "), 4) AS p" + q for q in ("25", "50", "75"))


@query("stat_summary", _DESCRIBE.format(c="c_custkey", x="c_custkey", p=_QUARTILES.format(x="c_custkey")) + " UNION ALL "
       + _DESCRIBE.format(c="c_acctbal", x="c_acctbal", p=_QUARTILES.format(x="c_acctbal")) + " UNION ALL "
       + _DESCRIBE.format(c="c_name", x="CAST(NULL AS DOUBLE)", p=", NULL, NULL, NULL"))
def stat_summary(spark, d):
    return _rounded(st.describe_long(table(spark, d, "customer"), ["c_custkey", "c_acctbal", "c_name"], (0.25, 0.5, 0.75)))


@query("na_fill", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'na') AS segment, nullif(c_nationkey, 7) AS nation FROM customer""")
def na_fill(spark, d):
    """Text columns only: a text default leaves numbers alone."""
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
                                           F.nullif("c_nationkey", F.lit(7)).alias("nation"))
    return c.na.fill("na")


@query("na_drop_replace", """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'MACHINES' ELSE c_mktsegment END AS segment
FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def na_drop_replace(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return c.na.drop(subset=["segment"]).na.replace("MACHINERY", "MACHINES", "segment")


@query("sample_rows", "SELECT 0 AS foreign_rows, true AS near_fraction, true AS repeatable FROM region WHERE r_regionkey = 0")
def sample_rows(spark, d):
    """Sampled rows with replacement come from the table and are near the fraction; the keyed sample repeats itself."""
    o = table(spark, d, "orders").select("o_orderkey")
    drawn = o.sample(True, 0.1, 100).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    keyed = sampling.keyed_sample(o, "o_orderkey", 0.1).withColumn("k1", F.lit(1))
    again = sampling.keyed_sample(o, "o_orderkey", 0.1).withColumn("k2", F.lit(1))
    both = (o.withColumn("known", F.lit(1)).join(drawn, "o_orderkey", "full")
            .join(keyed, "o_orderkey", "left").join(again, "o_orderkey", "left"))
    total = F.sum("known")
    near = lambda part: F.abs(part / total - 0.1) < F.lit(5) * F.sqrt(F.lit(0.1) / total)
    return both.agg(F.count_if(F.col("known").isNull()).cast("int").alias("foreign_rows"),
                    (near(F.sum("n")) & near(F.sum("k1"))).alias("near_fraction"),
                    F.bool_and(F.col("k1").eqNullSafe(F.col("k2"))).alias("repeatable"))


@query("sample_by", "SELECT o_orderstatus, o_orderstatus <> 'P' AS sampled FROM orders GROUP BY 1")
def sample_by(spark, d):
    """A fraction per status: half of F, all of O, none of P."""
    o = table(spark, d, "orders")
    kept = sampling.stratified_sample(o, "o_orderstatus", {"F": 0.5, "O": 1.0}, 7)
    share = kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("k"))
    total = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).join(share, "o_orderstatus", "left")
    ratio = F.coalesce("k", F.lit(0)) / F.col("n")
    ok = (F.when(F.col("o_orderstatus") == "F", F.abs(ratio - 0.5) < F.lit(5) * F.sqrt(F.lit(0.25) / F.col("n")))
          .when(F.col("o_orderstatus") == "O", ratio == 1).otherwise(ratio > 0))
    return total.select("o_orderstatus", ok.alias("sampled"))


@query("random_split", "SELECT o_orderkey, 1 AS in_parts FROM orders")
def random_split(spark, d):
    """Both parts together hold every row exactly once."""
    parts = table(spark, d, "orders").select("o_orderkey").randomSplit([0.5, 0.5], seed=11)
    return parts[0].union(parts[1]).groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("in_parts"))


@query("keyed_split", "SELECT o_orderkey, 1 AS in_parts FROM orders")
def keyed_split(spark, d):
    """The same by key hash, without the sort that a random split needs."""
    parts = sampling.keyed_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", [0.5, 0.3, 0.2])
    return parts[0].union(parts[1]).union(parts[2]).groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("in_parts"))


# --- sessions --------------------------------------------------------------------------------

_SESSIONS = """SELECT *, sum(CASE WHEN given IS NOT NULL OR prev IS NULL OR ts - prev > INTERVAL 1 HOUR THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM (
    SELECT event_id, user_id, ts, {given} AS given, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)"""
_PLAIN = _SESSIONS.format(given="CAST(NULL AS VARCHAR)")


@query("sessionize", f"""
SELECT event_id, user_id, ts, CAST(no AS BIGINT) AS session_no, user_id || '_' || CAST(no AS BIGINT) AS session_id FROM ({_PLAIN})""")
def sessionize(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return sessions.sessionize(e, "user_id", "ts", "event_id")


@query("sessionize_given_ids", f"""
WITH s AS ({_SESSIONS.format(given="CASE WHEN event_type = 'signup' THEN 'given-' || event_id END")})
SELECT event_id, user_id, CAST(no AS BIGINT) AS session_no,
       coalesce(max(given) OVER (PARTITION BY user_id, no), user_id || '_' || CAST(no AS BIGINT)) AS session_id FROM s""")
def sessionize_given_ids(spark, d):
    """A signup brings its own session id; later events stay in that session."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(
        F.col("event_type") == "signup", F.concat(F.lit("given-"), F.col("event_id").cast("string"))).alias("given"))
    return sessions.sessionize(e, "user_id", "ts", "event_id", given=F.col("given")).select(
        "event_id", "user_id", "session_no", "session_id")


@query("session_stats", f"""
SELECT user_id, user_id || '_' || CAST(no AS BIGINT) AS session_id, min(ts) AS session_start, max(ts) AS session_end,
       count(*) AS n_events FROM ({_PLAIN}) GROUP BY 1, 2""")
def session_stats(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return sessions.session_stats(sessions.sessionize(e, "user_id", "ts", "event_id"), "user_id", "ts")
