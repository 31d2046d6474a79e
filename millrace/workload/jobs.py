"""Business jobs on the data tables: sync, freshness, events, balances, transfers.

The event rules run unchanged on their own table layout: each input table is a view of the data
tables, limited to the period with filters that reach the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.functions.dates import period_bounds
from millrace.functions.records import FUND_SNAPSHOT, LEDGER, STOCK_SNAPSHOT, TRADE, parse_delimited
from millrace.functions.types import conform
from millrace.operators.ordered import running_totals
from millrace.plans import balances, bank_transfers, daily_sync, events, freshness
from millrace.session import materialize, work_path
from millrace.sources.files import table
from millrace.workload.registry import query
from millrace.workload.scalars import TRADE_SQL, ledger_lines, trade_lines

# --- business events -------------------------------------------------------------------------

COMMENDERS = ("Supplier#000000001", "Supplier#000000004", "Supplier#000000007")
MONTH, YEAR, EVENT_MONTH = "199603", "1996", "202401"
YEAR_RULES = ("010110", "010301", "010401", "010701", "010801", "010901", "011001", "011404", "011406", "012101")
EVENT_RULES = ("010501", "010601", "011201")


def _between(column: str, period: str):
    start, end = (F.lit(str(b)).cast("timestamp_ntz") for b in period_bounds(period))
    return (F.col(column) >= start) & (F.col(column) < end)


def _code(column: str, mapping: dict):
    return reduce(lambda w, kv: w.when(F.col(column) == kv[0], kv[1]), mapping.items(), F)


def event_tables(base: dict[str, DataFrame], period: str) -> dict:
    """The rule inputs as views of the data tables; a date column holds the period's name.

    Each entry opens its table when a rule asks for it.
    """
    c, nation, supplier = base["customer"], base["nation"], base["supplier"]
    o = base["orders"].where(_between("o_orderdate", period))
    e = base["events"].where(_between("ts", period))
    returned = base["lineitem"].where("l_returnflag = 'R'")
    label, number = F.lit(period), F.lit(int(period))
    cust_code, custid = F.col("o_custkey").alias("cust_code"), F.col("o_custkey").alias("custid")

    def bank_moves(status: str) -> DataFrame:
        """Moves of the period and of the period one year before it, each under its own label."""
        before = year_before(period)
        now = _between("o_orderdate", period)
        rows = base["orders"].where((F.col("o_orderstatus") == status) & (now | _between("o_orderdate", before)))
        return rows.select(custid, F.lit("1").alias("banktranid"), F.lit("2").alias("status"),
                           F.when(now, period).otherwise(before).alias("busi_date"))

    def rights() -> DataFrame:
        """Trading rights: pending high-priority orders, clicks and views, and markets by order status."""
        market = F.when(F.col("o_orderstatus") == "O", "5").when(F.col("o_orderstatus") == "F", "S").otherwise("P")
        nothing = F.lit(None).cast("string").alias("market")
        pending = o.where("o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'").select(
            custid, F.lit("0w").alias("securight"), nothing)
        visits = e.where("event_type IN ('click', 'view')").select(
            F.col("user_id").alias("custid"), _code("event_type", {"click": "05", "view": "06"}).alias("securight"), nothing)
        markets = o.select(custid, F.lit("0s").alias("securight"), market.alias("market"))
        return pending.union(visits).union(markets).select("*", F.lit(0).alias("status"), label.alias("opendate"))

    def applications() -> DataFrame:
        buyers = base.get("buyers") or buyers_of(base, period)
        return buyers.select(custid, label.alias("effectivedate"), F.lit("5").alias("status"))

    return {
        "custbaseinfo": lambda: c.select(
            F.col("c_custkey").alias("custid"), F.col("c_name").alias("mobileno"), label.alias("opendate"),
            F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1).alias("singleflag")),
        "user_basic_info": lambda: o.select(F.col("o_custkey").alias("user_code"),
                                            _code("o_orderstatus", {"O": 1}).alias("open_source")),
        "customer": lambda: c.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
            F.col("c_custkey").alias("custid"), F.col("n_name").alias("orgid")),
        "oa_s_cczq": lambda: c.join(supplier, F.col("c_nationkey") == F.col("s_nationkey")).select(
            F.col("c_custkey").alias("cust_code"), F.concat(F.lit(" "), "s_name").alias("commender_name")),
        "cgemsecuinfo": lambda: o.select(custid, label.alias("signdate"),
                                         _code("o_orderstatus", {"F": "00"}).alias("dealresult")),
        "cust_invest_pro": lambda: o.select(cust_code, label.alias("prof_sign_date"),
                                            _code("o_orderpriority", {"1-URGENT": "1"}).alias("prof_investor_type")),
        "secuid": rights,
        "opp_busi_data": lambda: e.where("value > 0").select(
            F.col("user_id").alias("cust_code"), F.col("ts").alias("oper_time"), F.lit("13").alias("proc_status"),
            _code("event_type", {"purchase": "D0008", "signup": "D0009"}).alias("busi_code")),
        "cust_agreement": lambda: o.select(
            cust_code, label.alias("eft_date"),
            _code("o_orderpriority", {"3-MEDIUM": "11", "4-NOT SPECIFIED": "26"}).alias("cust_agmt_type")),
        "private_fund_invest": lambda: o.select(
            cust_code, label.alias("apply_date"),
            _code("o_orderpriority", {"5-LOW": "1", "1-URGENT": "4"}).alias("fund_invest_type")),
        "cdtapplication": applications,
        "opt_trdacct": lambda: o.select(cust_code, label.alias("effect_date")),
        "otc_auto_invest_agr": lambda: o.select(
            cust_code, F.col("o_orderkey").alias("app_sno"), F.col("o_orderkey").alias("inst_sno"),
            F.lit("1").alias("agr_stat"), label.alias("app_date")),
        "otc_inst_base_info": lambda: returned.groupBy(F.col("l_orderkey").alias("inst_sno")).agg(
            F.min("l_partkey").alias("inst_id")),
        "otc_ec_sign": lambda: o.where("o_orderstatus IN ('O', 'F')").select(
            cust_code, label.alias("busi_date"), label.alias("sign_date"),
            _code("o_orderpriority", {"1-URGENT": 9512, "2-HIGH": 9513, "3-MEDIUM": 9573}).alias("inst_sno"),
            _code("o_orderstatus", {"O": "0", "F": "1"}).alias("sign_stat"), F.col("o_orderdate").alias("upd_timestamp")),
        "eccustsign": lambda: o.select(custid, number.alias("orderdate")),
        "otc_trd_orders": lambda: o.select(
            cust_code, label.alias("busi_date"), number.alias("app_date"),
            _code("o_orderstatus", {"F": "129"}).alias("trd_id"), _code("o_orderpriority", {"5-LOW": "0"}).alias("div_method")),
        "logbanktran": lambda: bank_moves("O"),
        "logbanktran_margin": lambda: bank_moves("P"),
    }


def base_tables(spark, d) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in ("customer", "nation", "supplier", "orders", "lineitem", "events")}


def rule_period(code: str) -> str:
    return YEAR if code in YEAR_RULES else EVENT_MONTH if code in EVENT_RULES else MONTH


def event_context(base: dict[str, DataFrame], period: str) -> events.EventContext:
    before = str(int(period[:4]) - 2) + period[4:]  # history starts after the year before last
    return events.EventContext(event_tables(base, period), period, COMMENDERS, before)


_C = "(SELECT CAST(c_custkey AS VARCHAR) AS cust_id, c_custkey, c_name AS cust_telno, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING')"
_MO = "(SELECT * FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199603')"
_YO = "(SELECT * FROM orders WHERE strftime(o_orderdate, '%Y') = '1996')"


def _rule_sql(code: str, source: str, where: str = "true", extra: dict[str, str] | None = None, distinct: str = "") -> str:
    """Oracle of one rule: ``source`` joins the customers ``c``."""
    period, extra = rule_period(code), extra or {}
    cols = ", ".join(f"CAST({extra.get(x, 'NULL')} AS VARCHAR) AS {x}" for x in events.EXTRA_COLUMNS)
    return (f"SELECT {distinct} c.cust_id, c.cust_telno, '{code}' AS busi_no, '{period}' AS busi_date, {cols} "
            f"FROM {_C} c {source} WHERE {where}")


def _by_order(code: str, orders: str, where: str, distinct: str = "") -> str:
    return _rule_sql(code, f"JOIN {orders} o ON o.o_custkey = c.c_custkey", where, distinct=distinct)


_NATION = "LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"
_NAMES = ", ".join(f"'{n}'" for n in COMMENDERS)
_SIGN = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
RULE_SQL = {
    "010109": _rule_sql("010109", f"JOIN {_MO} o ON o.o_custkey = c.c_custkey {_NATION}", "o_orderstatus = 'O'", {"orgid": "n_name"}),
    "010110": _rule_sql("010110", f"JOIN {_YO} o ON o.o_custkey = c.c_custkey {_NATION} JOIN supplier s ON s_nationkey = c.c_nationkey",
                        f"o_orderstatus = 'O' AND s_name IN ({_NAMES})", {"orgid": "n_name", "commender_name": "' ' || s_name"}),
    "010201": _by_order("010201", _MO, "o_orderstatus = 'F'"),
    "010301": _by_order("010301", _YO, "o_orderpriority = '1-URGENT'"),
    "010401": _by_order("010401", _YO, "o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'"),
    "010501": _rule_sql("010501", "JOIN events e ON e.user_id = c.c_custkey",
                        "event_type = 'purchase' AND value > 0 AND strftime(ts, '%Y%m') = '202401'"),
    "010601": _rule_sql("010601", "JOIN events e ON e.user_id = c.c_custkey",
                        "event_type = 'signup' AND value > 0 AND strftime(ts, '%Y%m') = '202401'"),
    "010701": _by_order("010701", _YO, "o_orderpriority = '3-MEDIUM'"),
    "010801": _by_order("010801", _YO, "o_orderpriority = '5-LOW'"),
    "010901": _by_order("010901", _YO, "o_orderpriority = '4-NOT SPECIFIED'"),
    "011001": _rule_sql("011001", f"""JOIN (SELECT o_custkey, array_to_string(list_sort(list(DISTINCT
        CASE o_orderstatus WHEN 'O' THEN '5' WHEN 'F' THEN 'S' ELSE 'P' END)), ',') AS markets FROM {_YO} GROUP BY 1) o
        ON o.o_custkey = c.c_custkey""", extra={
        "market": "CASE markets WHEN '5' THEN '沪港通' WHEN 'S' THEN '深港通' WHEN '5,S' THEN 'both' END"}),
    "011101": _rule_sql("011101", "JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l_orderkey = o_orderkey",
                        "l_returnflag = 'R' AND strftime(l_shipdate, '%Y%m') = '199603'"),
    "011201": _rule_sql("011201", "JOIN events e ON e.user_id = c.c_custkey",
                        "event_type IN ('click', 'view') AND strftime(ts, '%Y%m') = '202401'"),
    "011301": _by_order("011301", _MO, "true"),
    "011401": _rule_sql("011401", f"""JOIN {_MO} o ON o.o_custkey = c.c_custkey LEFT JOIN (
        SELECT l_orderkey, min(l_partkey) AS part FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l
        ON l_orderkey = o_orderkey""", extra={"ordersno": "o_orderkey", "fundcode": "part"}),
    "011403": _by_order("011403", _MO, f"""o_orderstatus = 'O' AND {_SIGN} AND c_custkey NOT IN (
        SELECT o_custkey FROM {_MO} x WHERE o_orderstatus = 'F' AND {_SIGN})""", "DISTINCT"),
    "011404": _by_order("011404", _YO, f"""o_orderstatus = 'O' AND {_SIGN} AND EXISTS (SELECT 1 FROM {_YO} x
        WHERE x.o_custkey = o.o_custkey AND x.o_orderstatus = 'F' AND x.{_SIGN}
        AND x.o_orderpriority <> o.o_orderpriority)""", "DISTINCT"),
    "011405": _by_order("011405", _MO, "true", "DISTINCT"),
    "011406": _by_order("011406", _YO, "o_orderstatus = 'F' AND o_orderpriority = '5-LOW'", "DISTINCT"),
    "011407": _by_order("011407", _MO, "o_orderpriority = '1-URGENT'", "DISTINCT"),
    "012101": _by_order("012101", _YO, """o_orderstatus IN ('O', 'P') AND c_custkey NOT IN (SELECT o_custkey FROM orders
        WHERE o_orderstatus IN ('O', 'P') AND strftime(o_orderdate, '%Y') = '1995')""", "DISTINCT"),
}


def _register_rule(code: str) -> None:
    @query(f"evt_{code}", RULE_SQL[code])
    def rule(spark, d):
        return events.rule_events(event_context(base_tables(spark, d), rule_period(code)), code)


for _rule in events.RULE_CODES:
    _register_rule(_rule)

_ALL_EVENTS = " UNION ALL ".join(f"({RULE_SQL[c]})" for c in events.RULE_CODES)
# The smallest tuple with NULLs first, like the smallest struct.
_ONCE = f"""SELECT cust_id || '_' || busi_date || '_' || busi_no AS key, * FROM (SELECT *, row_number() OVER (
    PARTITION BY cust_id, busi_no, busi_date ORDER BY {", ".join(c + " NULLS FIRST" for c in events.EXTRA_COLUMNS)}) AS rn
    FROM ({_ALL_EVENTS})) WHERE rn = 1"""
_FIELDS = "'{\"cust_id\":\"' || cust_id || '\",\"cust_telno\":\"' || cust_telno || '\",\"busi_no\":\"' || busi_no || '\",\"busi_date\":\"' || busi_date || '\"'"
_JSON = _FIELDS + "".join(
    f" || CASE WHEN {c} IS NULL THEN '' ELSE ',\"{c}\":\"' || {c} || '\"' END" for c in events.EXTRA_COLUMNS) + " || '}'"
MESSAGES_SQL = f"SELECT 'point' AS topic, key, {_JSON} AS value FROM ({_ONCE})"


def year_before(period: str) -> str:
    return str(int(period[:4]) - 1) + period[4:]


def buyers_of(base: dict[str, DataFrame], period: str) -> DataFrame:
    """Buyers of what came back, by the day it was shipped; orders of any day count."""
    shipped = base["lineitem"].where("l_returnflag = 'R'").where(_between("l_shipdate", period)).select("l_orderkey")
    orders = base["orders"].select("o_orderkey", "o_custkey")
    return shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey")


def by_day(orders: DataFrame, periods: Sequence[str]) -> DataFrame:
    """The columns of orders that rules use, of these periods and the same a year earlier, written in the order of the
    day, so that each rule reads its period only. The filter reaches the scan: other days are neither read nor copied."""
    wanted = reduce(lambda a, b: a | b, [_between("o_orderdate", p) for period in periods for p in (period, year_before(period))])
    used = orders.where(wanted).select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return materialize(used.repartitionByRange("o_orderdate").sortWithinPartitions("o_orderdate"), "orders-by-day")


def all_events(spark, d, ledger: DataFrame | None = None) -> DataFrame:
    """All rules, each for its period; one customer join for all of them.

    Orders, of which most of the rules' tables are made, are read for one copy by day and not by every rule.
    """
    base, groups = base_tables(spark, d), {}
    for code in events.RULE_CODES:
        groups.setdefault(rule_period(code), []).append(code)
    base["buyers"] = materialize(buyers_of(base, rule_period("011101")), "buyers")
    base["orders"] = by_day(base["orders"], list(groups))
    contexts = {period: event_context(base, period) for period in groups}
    rows = [events.candidates(contexts[period], codes) for period, codes in groups.items()]
    return events.new_events(reduce(DataFrame.unionByName, rows), events.individual_customers(contexts[MONTH]), ledger)


@query("business_events", MESSAGES_SQL)
def business_events(spark, d):
    return events.event_messages(all_events(spark, d))


@query("business_events_rerun", MESSAGES_SQL.replace("WHERE rn = 1", "WHERE rn = 1 AND busi_no >= '011001'"))
def business_events_rerun(spark, d):
    """The ledger already holds the events of the first rules; only the others go out."""
    first = all_events(spark, d).where(F.col("busi_no") < "011001").select("rowkey")
    return events.event_messages(all_events(spark, d, materialize(first, "event-ledger")))


# --- daily sync and freshness ----------------------------------------------------------------

_SYNC_ORDERS = """SELECT o_custkey || '_' || o_orderkey AS rowkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
    strftime(o_orderdate, '%Y%m') AS busi_month FROM orders WHERE {where}"""
_SYNC_CUSTOMER = "SELECT CAST(c_custkey AS VARCHAR) AS rowkey, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer"


def _sync_sql(where: str) -> str:
    cell = "SELECT '{t}' AS target, rowkey, 'cf' AS family, '{c}' AS qualifier, {c} AS value FROM {t}_rows"
    cells = [cell.format(t="orders", c=c) for c in ("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "busi_month")]
    cells += [cell.format(t="customer", c=c) for c in ("c_custkey", "c_name", "c_mktsegment")]
    return (f"WITH orders_rows AS ({_SYNC_ORDERS.format(where=where)}), customer_rows AS ({_SYNC_CUSTOMER}) "
            + " UNION ALL ".join(cells))


SYNC_SPECS = (daily_sync.SyncSpec("orders", ("o_custkey", "o_orderkey"), "busi_month"),
              daily_sync.SyncSpec("customer", ("c_custkey",)))


def run_sync(spark, d, day: str) -> DataFrame:
    """Sync both tables and read the exports back."""
    o = table(spark, d, "orders")
    if day != "-1":
        o = o.where(_between("o_orderdate", day))  # the scan-side form of the day filter
    load = {
        "orders": lambda: o.select("o_custkey", "o_orderkey", "o_orderstatus",
                                   F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                                   F.date_format("o_orderdate", "yyyyMM").alias("busi_month")),
        "customer": lambda: table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"),
    }
    paths = daily_sync.daily_sync(lambda name: load[name](), SYNC_SPECS, day, work_path(spark, "sync"))
    out = [spark.read.parquet(p).select(F.lit(s.target_name).alias("target"), "rowkey", "family", "qualifier", "value")
           for s, p in zip(SYNC_SPECS, paths)]
    return reduce(DataFrame.union, out)


@query("daily_sync", _sync_sql("strftime(o_orderdate, '%Y%m') = '199603'"))
def daily_sync_query(spark, d):
    return run_sync(spark, d, MONTH)


@query("daily_sync_full", _sync_sql("true"))
def daily_sync_full(spark, d):
    return run_sync(spark, d, "-1")


@query("freshness_ledger", """
WITH d AS (SELECT o_orderpriority AS name, o_orderdate < TIMESTAMP '1998-01-01' AS old, max(strftime(o_orderdate, '%Y%m%d')) AS day
           FROM orders GROUP BY 1, 2),
e AS (SELECT name, CASE WHEN old THEN '1998-01-02 06:00:00' ELSE '2001-09-01 06:00:00' END AS fed,
             CASE WHEN name = '1-URGENT' AND NOT old THEN '-1' ELSE day END AS day FROM d)
SELECT name || '_hbase' AS rowkey, name, 'hbase' AS type, max(fed) AS feed_in_time, arg_max(day, fed) AS last_data_time,
       CAST(max(CAST(day AS INTEGER)) AS VARCHAR) AS latest_data_time FROM e GROUP BY name""")
def freshness_ledger(spark, d):
    """Two runs per order priority: one up to 1997, a later one of which one target is a full-history run."""
    o, cut = table(spark, d, "orders"), F.lit("1998-01-01").cast("timestamp_ntz")
    last_day = lambda rows: rows.groupBy(F.col("o_orderpriority").alias("name")).agg(F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("day"))
    old, new = last_day(o.where(F.col("o_orderdate") < cut)), last_day(o.where(F.col("o_orderdate") >= cut))
    day = F.when(F.col("name") == "1-URGENT", "-1").otherwise(F.col("day"))
    first = freshness.feed_entries(old, F.lit("1998-01-02 06:00:00"), F.col("day"))
    second = freshness.feed_entries(new, F.lit("2001-09-01 06:00:00"), day)
    return freshness.merge_ledger(first, second)


# --- balances --------------------------------------------------------------------------------

_KEY = "fundid || '_' || secuid || '_' || orgid || '_' || market || '_' || stkcode || '_' || serverid"
SEED_DAY = 19980101
_COUNTED = "(bsflag IN ('03', '04') OR matchtype = '0')"
_SIGNED = "CASE WHEN bsflag IN ('03', '0B') THEN matchqty ELSE -matchqty END"


@query("balance_seed", """
WITH s AS (SELECT l_suppkey || '_A' || l_suppkey || '_0001_O_000001_1' AS rowkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bal,
                  l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY l_suppkey)
SELECT rowkey, 'cf' AS family, qualifier, value FROM s, LATERAL (VALUES ('serverid', '1'), ('orgid', '0001'),
  ('fundid', CAST(l_suppkey AS VARCHAR)), ('market', 'O'), ('secuid', 'A' || l_suppkey), ('stkcode', '000001'),
  ('stkbal', CAST(bal AS VARCHAR)), ('bizdate', '19980101')) v(qualifier, value)""")
def balance_seed(spark, d):
    """A 39-column stock snapshot of one day, as cells; the columns that hold nothing have no cells."""
    held = table(spark, d, "lineitem").where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("stkbal"))
    snapshot = held.select(
        F.lit(1).cast("bigint").alias("serverid"), F.lit("0001").alias("orgid"), F.col("l_suppkey").alias("fundid"),
        F.lit("O").alias("market"), F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("secuid"),
        F.lit("000001").alias("stkcode"), "stkbal", F.lit(SEED_DAY).cast("bigint").alias("bizdate"))
    full = conform(snapshot, STOCK_SNAPSHOT)
    return balances.seed_cells(full, "bizdate", str(SEED_DAY), balances.STOCK_KEY)


@query("fund_seed", """
WITH s AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,18)) AS bal FROM orders
           WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT o_custkey || '_0001_0_1' AS rowkey, 'cf' AS family, qualifier, value FROM s, LATERAL (VALUES ('serverid', '1'),
  ('orgid', '0001'), ('fundid', CAST(o_custkey AS VARCHAR)), ('moneytype', '0'), ('fundbal', CAST(bal AS VARCHAR)),
  ('busi_date', '19980101')) v(qualifier, value)""")
def fund_seed(spark, d):
    """A 33-column fund snapshot of one day, as cells."""
    held = table(spark, d, "orders").where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).groupBy(
        F.col("o_custkey").alias("fundid")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("fundbal"))
    snapshot = held.select("fundid", F.col("fundbal").cast("decimal(38,18)").alias("fundbal"), F.lit(1).cast("bigint").alias("serverid"),
                           F.lit("0001").alias("orgid"), F.lit("0").alias("moneytype"), F.lit(str(SEED_DAY)).alias("busi_date"))
    return balances.seed_cells(conform(snapshot, FUND_SNAPSHOT), "busi_date", str(SEED_DAY), balances.FUND_KEY)


@query("signed_delta", f"""
SELECT {_KEY} AS rowkey, {_SIGNED} AS delta, matchsno AS last_no, trddate AS last_day FROM ({TRADE_SQL}) WHERE {_COUNTED}""")
def signed_delta(spark, d):
    return balances.stock_deltas(trade_lines(spark, d).transform(parse_delimited, TRADE))


def balance_seed_of(spark, d) -> DataFrame:
    """Seed from the trades up to the seed day. The scan reads these days alone; the messages are filtered in any case."""
    day_after = (dt.datetime.strptime(str(SEED_DAY), "%Y%m%d") + dt.timedelta(days=1)).isoformat()
    lines = trade_lines(spark, d, "l_shipdate").where(F.col("l_shipdate") < F.lit(day_after).cast("timestamp_ntz"))
    early = balances.sum_deltas(balances.distinct_deltas(lines, upto_day=SEED_DAY))
    return early.select("rowkey", F.col("delta").alias("balance"))


def seed_and_trades(spark, d):
    """Seed from the trades up to the seed day, and all trades as records."""
    trades = trade_lines(spark, d).transform(balances.distinct_messages).transform(parse_delimited, TRADE)
    early = balances.sum_deltas(balances.stock_deltas(trades.where(F.col("trddate") <= SEED_DAY)))
    return early.select("rowkey", F.col("delta").alias("balance")), trades


BALANCE_SQL = f"""
WITH t AS (SELECT {_KEY} AS rowkey, {_SIGNED} AS delta, matchsno, trddate
           FROM ({TRADE_SQL.replace("FROM lineitem", "FROM (SELECT DISTINCT * FROM lineitem)")}) WHERE {_COUNTED}),
late AS (SELECT * FROM t WHERE trddate > {SEED_DAY}),
last AS (SELECT rowkey, trddate AS last_day, max(matchsno) AS last_no FROM late
         WHERE (rowkey, trddate) IN (SELECT rowkey, max(trddate) FROM late GROUP BY 1) GROUP BY 1, 2)
SELECT t.rowkey, CAST(sum(delta) AS BIGINT) AS balance, any_value(last_no) AS last_no, any_value(last_day) AS last_day
FROM t LEFT JOIN last ON t.rowkey = last.rowkey GROUP BY t.rowkey"""


@query("running_balance", BALANCE_SQL)
def running_balance(spark, d):
    seed, trades = seed_and_trades(spark, d)
    return balances.running_balance(seed, balances.stock_deltas(trades, SEED_DAY))


@query("running_total_rows", BALANCE_SQL[:BALANCE_SQL.index("late AS")].rstrip().rstrip(",") + """
SELECT rowkey, trddate AS last_day, matchsno AS last_no, delta, CAST(sum(delta) OVER (
    PARTITION BY rowkey ORDER BY trddate, matchsno, delta ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance FROM t""")
def running_total_rows(spark, d):
    """The balance after every trade."""
    deltas = balances.stock_deltas(seed_and_trades(spark, d)[1])
    return running_totals(deltas, ["rowkey"], ["last_day", "last_no", "delta"], "delta", "balance").select(
        "rowkey", "last_day", "last_no", "delta", "balance")


@query("balance_rejects", f"""
SELECT matchsno, stkcode, trddate FROM ({TRADE_SQL}) WHERE matchsno % 7 = 0""")
def balance_rejects(spark, d):
    """Trades whose organisation cannot be read move no balance; they come out on a side."""
    trades = trade_lines(spark, d).transform(parse_delimited, TRADE)
    damaged = trades.withColumn("orgid", F.when(F.col("matchsno") % 7 != 0, F.col("orgid")))
    return balances.rejects(damaged, balances.STOCK_KEY).select("matchsno", "stkcode", "trddate")


_FUND_KEY = "{c} || '_0001_0_1'"


FUND_SQL = f"""
WITH u AS (SELECT {_FUND_KEY.format(c="l_suppkey")} AS rowkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS delta,
    l_orderkey AS no, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS day FROM lineitem
  UNION ALL SELECT {_FUND_KEY.format(c="o_custkey")}, CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) FROM orders),
last AS (SELECT rowkey, day AS last_day, max(no) AS last_no FROM u
         WHERE (rowkey, day) IN (SELECT rowkey, max(day) FROM u GROUP BY 1) GROUP BY 1, 2)
SELECT u.rowkey, CAST(sum(delta) AS DECIMAL(28,2)) AS balance, any_value(last_no) AS last_no, any_value(last_day) AS last_day
FROM u JOIN last ON u.rowkey = last.rowkey GROUP BY u.rowkey"""


def fund_records(trades: DataFrame, ledger: DataFrame) -> DataFrame:
    """Changes from trade and ledger lines, batch or stream; amounts with two decimals."""
    money = lambda df, c: df.withColumn(c, F.col(c).cast("decimal(18,2)"))
    return balances.fund_deltas(money(parse_delimited(trades, TRADE), "clearamt"),
                                money(parse_delimited(ledger, LEDGER), "fundeffect"))


@query("fund_balance", FUND_SQL)
def fund_balance(spark, d):
    """Clearing amounts of trades and effects of ledger records, from both text record formats."""
    none = spark.createDataFrame([], "rowkey STRING, balance DECIMAL(18,2)")
    deltas = fund_records(trade_lines(spark, d), ledger_lines(spark, d))
    return balances.running_balance(none, deltas).withColumn("balance", F.col("balance").cast("decimal(28,2)"))


# --- bank transfers --------------------------------------------------------------------------


def transfer_records(df: DataFrame) -> DataFrame:
    """Events as ledger records; the event type gives the business code, two of which are not transfers."""
    code = (F.when(F.col("event_type") == "click", 160021).when(F.col("event_type") == "purchase", 160022)
            .when(F.col("event_type") == "signup", 140055).otherwise(99))
    day = F.date_format("ts", "yyyyMMdd").cast("int")
    return df.select(
        (F.col("event_id") % 7).cast("int").alias("sno"), F.col("user_id").alias("custid"), F.col("event_type").alias("custname"),
        (F.col("user_id") + 1000).alias("fundid"), F.lit("0 ").alias("moneytype"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("fundeffect"), day.alias("operdate"), day.alias("bizdate"),
        code.alias("digestid"), F.col("event_id").alias("version"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("orgid", "string"), ("orderdate", "int"), ("ordertime", "int"))])


def transfer_messages(df: DataFrame) -> DataFrame:
    records = transfer_records(df)
    payload = F.struct(*[c for c in records.columns if c != "version"])
    return records.select(F.encode(F.to_json(payload), "UTF-8").alias("value"), "version")


TRANSFER_SQL = """
WITH m AS (SELECT CAST(event_id % 7 AS VARCHAR) AS sno, CAST(user_id AS VARCHAR) AS cust_id, event_type AS cust_name,
    CAST(user_id + 1000 AS VARCHAR) AS cptl_acid, reverse(CAST(user_id + 1000 AS VARCHAR)) AS reverse_cptl_acid, '0' AS crrc_cd,
    '' AS brch_id, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS cptl_occr_amt, strftime(ts, '%Y%m%d') AS operdate,
    '' AS orde_dt, '' AS orde_time, CASE event_type WHEN 'click' THEN '160021' WHEN 'purchase' THEN '160022' ELSE '140055' END AS busi_digt_cd,
    strftime(ts, '%Y%m%d') AS etl_dt, event_id FROM events WHERE event_type IN ('click', 'purchase', 'signup'))
SELECT * EXCLUDE (event_id, rn) FROM (SELECT reverse_cptl_acid || '_' || operdate || '_' || etl_dt || '_' || sno AS rowkey, *,
    row_number() OVER (PARTITION BY reverse_cptl_acid, operdate, etl_dt, sno ORDER BY event_id DESC) AS rn FROM m) WHERE rn = 1"""


@query("bank_transfer_batch", TRANSFER_SQL)
def bank_transfer_batch(spark, d):
    rows = bank_transfers.transfer_rows(transfer_messages(table(spark, d, "events")))
    return bank_transfers.merge_transfers(rows, ["version"])
