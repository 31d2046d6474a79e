"""Business events: rules find customers who did something on a day; each event goes out once.

All rules together make one plan. Rules over the same table share a scan, the customer base is
joined once to the candidates of all rules, and the ledger of past events is anti-joined as a set.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.dates import in_period, period_sql
from millrace.functions.text import joined_key, lookup, sorted_set
from millrace.operators.joins import drop_matching
from millrace.sinks.writers import to_messages

EXTRA_COLUMNS = ["orgid", "commender_name", "market", "ordersno", "fundcode"]
EVENT_COLUMNS = ["cust_id", "busi_no", "busi_date", *EXTRA_COLUMNS]


@dataclass(frozen=True)
class EventContext:
    """Input tables by name (or functions that open them), the business date, and rule settings."""

    tables: Mapping[str, DataFrame | Callable[[], DataFrame]]
    day: str
    commenders: Sequence[str] = ()
    history_start: str = "20200101"
    _opened: dict = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self):
        if not self.day.isdigit():  # it becomes part of SQL text
            raise ValueError(f"not a business date: {self.day!r}")

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            found = self.tables[name]
            self._opened[name] = found() if callable(found) else found
        return self._opened[name]


@dataclass(frozen=True)
class MatchRule:
    """Rows of ``table`` whose columns hold the listed values on the business date."""

    code: str
    table: str
    customer: str
    date: str
    accepts: Mapping[str, tuple] = field(default_factory=dict)

    def condition(self, types: Mapping[str, str], day: str) -> str:
        """SQL predicate; the date is compared in the type of its column."""
        kind = types[self.date]
        on_day = (period_sql(self.date, day) if kind.startswith("timestamp")
                  else f"{self.date} = '{day}'" if kind == "string" else f"{self.date} = CAST('{day}' AS {kind})")
        return " AND ".join([on_day, *(f"{c} IN ({', '.join(map(repr, v))})" for c, v in self.accepts.items())])


# Rule code, table, customer column, date column, accepted values.
MATCH_RULES = (
    MatchRule("010201", "cgemsecuinfo", "custid", "signdate", {"dealresult": ("00",)}),
    MatchRule("010301", "cust_invest_pro", "cust_code", "prof_sign_date", {"prof_investor_type": ("1",)}),
    MatchRule("010401", "secuid", "custid", "opendate", {"securight": ("0w",), "status": (0,)}),
    MatchRule("010501", "opp_busi_data", "cust_code", "oper_time", {"busi_code": ("D0008",), "proc_status": ("13",)}),
    MatchRule("010601", "opp_busi_data", "cust_code", "oper_time", {"busi_code": ("D0009",), "proc_status": ("13",)}),
    MatchRule("010701", "cust_agreement", "cust_code", "eft_date", {"cust_agmt_type": ("11",)}),
    MatchRule("010801", "private_fund_invest", "cust_code", "apply_date", {"fund_invest_type": ("1",)}),
    MatchRule("010901", "cust_agreement", "cust_code", "eft_date", {"cust_agmt_type": ("26",)}),
    MatchRule("011101", "cdtapplication", "custid", "effectivedate", {"status": ("5",)}),
    MatchRule("011201", "secuid", "custid", "opendate", {"securight": ("05", "06"), "status": (0,)}),
    MatchRule("011301", "opt_trdacct", "cust_code", "effect_date"),
)
# Label by the sorted set of markets; products of the sign-up rules; filters of single rules.
MARKET_LABELS = {"5": "沪港通", "S": "深港通", "5,S": "both"}
SIGNED_PRODUCTS = (9512, 9513, 9573)
OPEN_SOURCE_ONLINE = 1
MARKET_RIGHT = "0s"
AUTO_INVEST_ACTIVE = "1"
DIVIDEND_TRADE, DIVIDEND_METHOD = "129", "0"
PRIVATE_FUND_TYPE = "4"
TRANSFER_IN, TRANSFER_DONE = "1", "2"


def individual_customers(ctx: EventContext) -> DataFrame:
    base = ctx.table("custbaseinfo").where(F.col("singleflag") == 0)
    return base.select(F.col("custid").cast("string").alias("cust_id"), F.col("mobileno").alias("cust_telno"))


def _candidates(df: DataFrame, customer: str, code: str, ctx: EventContext, **extra: str) -> DataFrame:
    """Rows in the common shape of all rules, from SQL text for the code and the extra columns.

    The customer key is text on both sides of the later join.
    """
    return df.selectExpr(
        f"CAST({customer} AS STRING) AS cust_id", f"{code} AS busi_no", f"'{ctx.day}' AS busi_date",
        *[f"CAST({extra.get(c, 'NULL')} AS STRING) AS {c}" for c in EXTRA_COLUMNS])


def matched(ctx: EventContext, rules: Sequence[MatchRule]) -> list[DataFrame]:
    """Candidates of simple rules: one scan per (table, customer column), whatever the number of rules."""
    groups: dict[tuple[str, str], list[MatchRule]] = {}
    for rule in rules:
        groups.setdefault((rule.table, rule.customer), []).append(rule)
    out = []
    for (table, customer), members in groups.items():
        df = ctx.table(table)
        types = dict(df.dtypes)
        conds = {r.code: r.condition(types, ctx.day) for r in members}
        df = df.where(" OR ".join(f"({c})" for c in conds.values()))
        code = f"'{members[0].code}'"
        if len(members) > 1:
            cases = ", ".join(f"IF({c}, '{k}', NULL)" for k, c in conds.items())
            code = f"explode(array_compact(array({cases})))"
        out.append(_candidates(df, customer, code, ctx))
    return out


def opened_online(ctx: EventContext) -> DataFrame:
    """010109: account opened online that day, with the organisation of the customer if known."""
    base = ctx.table("custbaseinfo").where((F.col("opendate") == ctx.day) & (F.col("singleflag") == 0))
    users = ctx.table("user_basic_info").where(F.col("open_source") == OPEN_SOURCE_ONLINE)
    opened = base.join(users, base["custid"] == users["user_code"]).select(base["custid"])
    return opened.join(ctx.table("customer").select("custid", "orgid"), "custid", "left")


def opened_rule(ctx: EventContext) -> DataFrame:
    return _candidates(opened_online(ctx), "custid", "'010109'", ctx, orgid="orgid")


def commended_rule(ctx: EventContext) -> DataFrame:
    """010110: the same, recommended by one of the listed people."""
    named = ctx.table("oa_s_cczq").where(F.trim("commender_name").isin(*ctx.commenders))
    rows = opened_online(ctx).join(named, F.col("custid").cast("string") == F.col("cust_code").cast("string"))
    return _candidates(rows, "custid", "'010110'", ctx, orgid="orgid", commender_name="commender_name")


def market_rule(ctx: EventContext) -> DataFrame:
    """011001: the markets opened that day, as one label per customer."""
    opened = ctx.table("secuid").where(
        (F.col("securight") == MARKET_RIGHT) & (F.col("status") == 0) & (F.col("opendate") == ctx.day))
    markets = opened.groupBy("custid").agg(lookup(MARKET_LABELS, sorted_set(F.col("market"))).alias("market"))
    return _candidates(markets, "custid", "'011001'", ctx, market="market")


def auto_invest_rule(ctx: EventContext) -> DataFrame:
    """011401: automatic investment agreement, with the fund if it is known."""
    agreements = ctx.table("otc_auto_invest_agr").where(
        (F.col("agr_stat") == AUTO_INVEST_ACTIVE) & (F.col("app_date") == ctx.day))
    rows = agreements.join(ctx.table("otc_inst_base_info").select("inst_sno", "inst_id"), "inst_sno", "left")
    return _candidates(rows, "cust_code", "'011401'", ctx, ordersno="app_sno", fundcode="inst_id")


def _signed(ctx: EventContext) -> tuple[DataFrame, DataFrame]:
    """Sign-ups of the day and cancellations of the day, for the listed products."""
    rows = ctx.table("otc_ec_sign").where((F.col("busi_date") == ctx.day) & F.col("inst_sno").isin(*SIGNED_PRODUCTS))
    signed = rows.where((F.col("sign_date") == ctx.day) & (F.col("sign_stat") == "0"))
    cancelled = rows.where(in_period(F.col("upd_timestamp"), ctx.day) & (F.col("sign_stat") != "0"))
    return signed.select("cust_code", "inst_sno"), cancelled.select("cust_code", "inst_sno")


def signed_rule(ctx: EventContext) -> DataFrame:
    """011403: signed up and did not cancel anything that day."""
    signed, cancelled = _signed(ctx)
    kept = drop_matching(signed.select("cust_code").distinct(), cancelled, ["cust_code"])
    return _candidates(kept, "cust_code", "'011403'", ctx)


def switched_rule(ctx: EventContext) -> DataFrame:
    """011404: signed up for one product and cancelled another.

    Two customers' products differ exactly when their smallest and largest products are not all
    equal, so each side is reduced to one row per customer and no pairs are formed.
    """
    signed, cancelled = _signed(ctx)
    span = lambda df, p: df.groupBy("cust_code").agg(F.min("inst_sno").alias(p + "lo"), F.max("inst_sno").alias(p + "hi"))
    both = span(signed, "s_").join(span(cancelled, "c_"), "cust_code")
    return _candidates(both.where((F.col("s_lo") != F.col("c_hi")) | (F.col("s_hi") != F.col("c_lo"))),
                       "cust_code", "'011404'", ctx)


def appointed_rule(ctx: EventContext) -> DataFrame:
    """011405: the date is stored as a number."""
    rows = ctx.table("eccustsign").where(F.col("orderdate") == int(ctx.day))
    return _candidates(rows.select("custid").distinct(), "custid", "'011405'", ctx)


def dividend_rule(ctx: EventContext) -> DataFrame:
    """011406: the business date is text, the application date a number."""
    rows = ctx.table("otc_trd_orders").where(
        (F.col("busi_date") == ctx.day) & (F.col("app_date") == int(ctx.day))
        & (F.col("trd_id") == DIVIDEND_TRADE) & (F.col("div_method") == DIVIDEND_METHOD))
    return _candidates(rows.select("cust_code").distinct(), "cust_code", "'011406'", ctx)


def private_fund_rule(ctx: EventContext) -> DataFrame:
    rows = ctx.table("private_fund_invest").where(
        (F.col("fund_invest_type") == PRIVATE_FUND_TYPE) & (F.col("apply_date") == ctx.day))
    return _candidates(rows.select("cust_code").distinct(), "cust_code", "'011407'", ctx)


def first_transfer_rule(ctx: EventContext) -> DataFrame:
    """012101: first transfer ever. Both sources are read once; per customer the transfers of the
    day and of the earlier range are only counted."""
    done = (F.col("banktranid") == TRANSFER_IN) & (F.col("status") == TRANSFER_DONE)
    since = (F.col("busi_date") > ctx.history_start) & (F.col("busi_date") <= ctx.day)
    moves = [ctx.table(n).where(done & since).select("custid", "busi_date")
             for n in ("logbanktran", "logbanktran_margin")]
    per_customer = moves[0].union(moves[1]).groupBy("custid").agg(F.min("busi_date").alias("first_date"))
    return _candidates(per_customer.where(F.col("first_date") == ctx.day), "custid", "'012101'", ctx)


SPECIAL_RULES: dict[str, Callable[[EventContext], DataFrame]] = {
    "010109": opened_rule,
    "010110": commended_rule,
    "011001": market_rule,
    "011401": auto_invest_rule,
    "011403": signed_rule,
    "011404": switched_rule,
    "011405": appointed_rule,
    "011406": dividend_rule,
    "011407": private_fund_rule,
    "012101": first_transfer_rule,
}
RULE_CODES = tuple(sorted([r.code for r in MATCH_RULES] + list(SPECIAL_RULES)))


def candidates(ctx: EventContext, codes: Sequence[str] = RULE_CODES) -> DataFrame:
    """Rows of the given rules before the customer base is joined."""
    frames = matched(ctx, [r for r in MATCH_RULES if r.code in codes])
    frames += [SPECIAL_RULES[c](ctx) for c in codes if c in SPECIAL_RULES]
    return reduce(DataFrame.unionByName, frames)


def with_customer(rows: DataFrame, customers: DataFrame) -> DataFrame:
    return rows.join(customers, "cust_id").select("cust_id", "cust_telno", "busi_no", "busi_date", *EXTRA_COLUMNS)


def rule_events(ctx: EventContext, code: str) -> DataFrame:
    """The rows of one rule."""
    return with_customer(candidates(ctx, [code]), individual_customers(ctx))


def new_events(rows: DataFrame, customers: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """One row per ``rowkey = cust_id_busi_date_busi_no`` that the ledger does not hold yet.

    Repeats are merged before the customers are joined, with map-side partial results, so a
    customer with very many rows arrives as one row per rule.
    """
    once = rows.groupBy("cust_id", "busi_no", "busi_date").agg(F.min(F.struct(*EXTRA_COLUMNS)).alias("_x")).select(
        "cust_id", "busi_no", "busi_date", "_x.*")
    events = with_customer(once, customers).withColumn(
        "rowkey", joined_key(F.col("cust_id"), F.col("busi_date"), F.col("busi_no")))
    return events if ledger is None else events.join(ledger.select("rowkey"), "rowkey", "left_anti")


def event_messages(events: DataFrame, topic: str = "point") -> DataFrame:
    """``(topic, key, value)``: the non-NULL fields of each event as JSON."""
    return to_messages(events.select("rowkey", "cust_id", "cust_telno", "busi_no", "busi_date", *EXTRA_COLUMNS),
                       topic, "rowkey")


def publish(ctx: EventContext, ledger_path: str, message_path: str, topic: str = "point") -> None:
    """Emit the day's new events and enter them in the ledger.

    The messages are written once per day and rule run, and the ledger is filled from the written
    messages, so both always hold the same events and a re-run after a failure completes them.
    """
    customers = individual_customers(ctx)
    spark = customers.sparkSession
    target = f"{message_path}/busi_date={ctx.day}"
    known = spark.read.schema("rowkey STRING, busi_date STRING").parquet(ledger_path).where(
        F.col("busi_date") == ctx.day) if _exists(spark, ledger_path) else None
    events = new_events(candidates(ctx), customers, known)
    run = f"{target}/run={0 if known is None else known.count()}"
    event_messages(events, topic).write.mode("overwrite").parquet(run)
    spark.read.parquet(run).select(F.col("key").alias("rowkey"), F.lit(ctx.day).alias("busi_date")).write.mode(
        "append").partitionBy("busi_date").parquet(ledger_path)


def _exists(spark, path: str) -> bool:
    try:
        spark.read.schema("rowkey STRING").parquet(path).limit(1).collect()
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
