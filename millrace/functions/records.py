"""Wide records that arrive as delimited text or JSON."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Record layouts, in wire order.
TRADE_FIELDS = """
serverid BIGINT, matchsno BIGINT, operdate BIGINT, custid BIGINT, fundid BIGINT, moneytype STRING,
fundkind STRING, fundlevel STRING, fundgroup STRING, orgid STRING, brhid STRING, secuid STRING,
rptsecuid STRING, bsflag STRING, rptbs STRING, matchtype STRING, ordersno STRING, orderid STRING,
market STRING, stkcode STRING, stkname STRING, stktype STRING, trdid STRING, orderprice DECIMAL(38,18),
bondintr DECIMAL(38,18), orderqty BIGINT, seat STRING, matchtime BIGINT, matchprice DECIMAL(38,18),
matchqty BIGINT, matchamt DECIMAL(38,18), matchcode STRING, clearamt DECIMAL(38,18), operid BIGINT,
operlevel STRING, operorg STRING, operway STRING, bankcode STRING, bankbranch STRING, banknetplace STRING,
sourcetype STRING, recnum BIGINT, bankorderid STRING, bankid STRING, exteffectamt DECIMAL(38,18),
bankrtnflag STRING, remark STRING, creditid STRING, creditflag STRING, trddate BIGINT
"""
LEDGER_FIELDS = """
serverid BIGINT, operdate BIGINT, cleardate BIGINT, bizdate BIGINT, sno BIGINT, relativesno BIGINT,
custid BIGINT, custname STRING, fundid BIGINT, moneytype STRING, orgid STRING, brhid STRING, custkind STRING,
custgroup STRING, fundkind STRING, fundlevel STRING, fundgroup STRING, digestid BIGINT,
fundeffect DECIMAL(38,18), fundbal DECIMAL(38,18), secuid STRING, market STRING, biztype STRING,
stkcode STRING, stktype STRING, bankcode STRING, trdbankcode STRING, bankbranch STRING, banknetplace STRING,
stkname STRING, stkeffect BIGINT, stkbal BIGINT, orderid STRING, trdid STRING, orderqty BIGINT,
orderprice DECIMAL(38,18), bondintr DECIMAL(38,18), orderdate BIGINT, ordertime BIGINT, matchqty BIGINT,
matchamt DECIMAL(38,18), seat STRING, matchtimes BIGINT, matchprice DECIMAL(38,18), matchtime BIGINT,
matchcode STRING, fee_jsxf DECIMAL(38,18), fee_sxf DECIMAL(38,18), fee_yhs DECIMAL(38,18),
fee_ghf DECIMAL(38,18), fee_qsf DECIMAL(38,18), fee_jygf DECIMAL(38,18), fee_jsf DECIMAL(38,18),
fee_zgf DECIMAL(38,18), fee_qtf DECIMAL(38,18), bsflag STRING, feefront DECIMAL(38,18), sourcetype STRING,
bankid STRING, agentid BIGINT, operid BIGINT, operway STRING, operorg STRING, operlevel STRING, netaddr STRING,
chkoper BIGINT, checkflag STRING, brokerid BIGINT, custmgrid BIGINT, funduser0 BIGINT, funduser1 BIGINT,
privilege DECIMAL(38,18), remark STRING, ordersno BIGINT, pathid STRING, cancelflag STRING, reportkind STRING,
creditid STRING, creditflag STRING, creditmethod STRING, rfscontractno BIGINT, busi_date STRING
"""
LEDGER_JSON_FIELDS = """
serverid INT, operdate INT, cleardate INT, bizdate INT, sno INT, relativesno INT, custid BIGINT,
custname STRING, fundid BIGINT, moneytype STRING, orgid STRING, brhid STRING, custkind STRING,
custgroup STRING, fundkind STRING, fundlevel STRING, fundgroup STRING, digestid INT, fundeffect STRING,
fundbal STRING, secuid STRING, market STRING, biztype STRING, stkcode STRING, stktype STRING, bankcode STRING,
trdbankcode STRING, bankbranch STRING, banknetplace STRING, stkname STRING, stkeffect BIGINT, stkbal BIGINT,
orderid STRING, trdid STRING, orderqty BIGINT, orderprice STRING, bondintr STRING, orderdate INT,
ordertime INT, matchqty BIGINT, matchamt STRING, seat STRING, matchtimes INT, matchprice STRING, matchtime INT,
matchcode STRING, fee_jsxf STRING, fee_sxf STRING, fee_yhs STRING, fee_ghf STRING, fee_qsf STRING,
fee_jygf STRING, fee_jsf STRING, fee_zgf STRING, fee_qtf STRING, bsflag STRING, feefront STRING,
sourcetype STRING, bankid STRING, agentid BIGINT, operid INT, operway STRING, operorg STRING, operlevel STRING,
netaddr STRING, chkoper INT, checkflag STRING, brokerid BIGINT, custmgrid BIGINT, funduser0 BIGINT,
funduser1 INT, privilege STRING, remark STRING, ordersno INT, pathid STRING, cancelflag STRING,
reportkind STRING, creditid STRING, creditflag STRING, prodcode STRING, settrate STRING, fortuneid BIGINT,
collecttime STRING
"""
# Text columns of the JSON ledger record that hold decimals.
LEDGER_JSON_DECIMALS = {
    "fundeffect": "decimal(19,2)", "fundbal": "decimal(19,2)",
    "matchamt": "decimal(19,2)", "privilege": "decimal(19,2)",
    "orderprice": "decimal(9,3)", "matchprice": "decimal(9,3)",
    "bondintr": "decimal(12,8)", "settrate": "decimal(12,8)",
    "fee_jsxf": "decimal(12,2)", "fee_sxf": "decimal(12,2)", "fee_yhs": "decimal(12,2)",
    "fee_ghf": "decimal(12,2)", "fee_qsf": "decimal(12,2)", "fee_jygf": "decimal(12,2)",
    "fee_jsf": "decimal(12,2)", "fee_zgf": "decimal(12,2)", "fee_qtf": "decimal(12,2)",
    "feefront": "decimal(12,2)",
}
# Snapshot table layouts.
STOCK_SNAPSHOT_FIELDS = """
serverid BIGINT, custid BIGINT, orgid STRING, fundid BIGINT, moneytype STRING, market STRING, secuid STRING,
seat STRING, stkcode STRING, stklastbal BIGINT, stkbal BIGINT, stkavl BIGINT, stkbuy BIGINT, stksale BIGINT,
stkbuysale BIGINT, stkuncomebuy BIGINT, stkuncomesale BIGINT, stkfrz BIGINT, stkunfrz BIGINT,
stknightfrz BIGINT, stktrdfrz BIGINT, stktrdunfrz BIGINT, stkdiff BIGINT, stksalediff BIGINT, stkremain BIGINT,
stkcorpremain BIGINT, creditstkbal BIGINT, creditstkbuysale BIGINT, stkflag STRING, lastbuycost DECIMAL(38,18),
lastprofitcost DECIMAL(38,18), buycost DECIMAL(38,18), profitcost DECIMAL(38,18), mktval DECIMAL(38,18),
stkavl_in BIGINT, stkavl_out BIGINT, stkbuysale2 BIGINT, stkdecimal DECIMAL(38,18), bizdate BIGINT
"""
FUND_SNAPSHOT_FIELDS = """
serverid BIGINT, orgid STRING, fundseq BIGINT, fundid BIGINT, moneytype STRING, custid BIGINT,
fundlastbal DECIMAL(38,18), fundbal DECIMAL(38,18), fundavl DECIMAL(38,18), overdraw DECIMAL(38,18),
fundbuy DECIMAL(38,18), fundsale DECIMAL(38,18), funduncomebuy DECIMAL(38,18), funduncomesale DECIMAL(38,18),
fundfrz DECIMAL(38,18), fundunfrz DECIMAL(38,18), fundtrdfrz DECIMAL(38,18), fundtrdunfrz DECIMAL(38,18),
fundnightfrz DECIMAL(38,18), fundloan DECIMAL(38,18), creditbal DECIMAL(38,18), creditbuysale DECIMAL(38,18),
creditavl DECIMAL(38,18), creditbuy DECIMAL(38,18), creditsale DECIMAL(38,18), creditamtused DECIMAL(38,18),
fundflag STRING, otherasset DECIMAL(38,18), marketvalue DECIMAL(38,18), fundstandby DECIMAL(38,18),
fundbuysale DECIMAL(38,18), fundbalprefrz DECIMAL(38,18), busi_date STRING
"""

_TYPES = {"STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "DECIMAL(38,18)": T.DecimalType(38, 18)}


def record_schema(fields: str) -> T.StructType:
    """Schema of a list of ``name TYPE``, without the session that Spark's own parser needs."""
    pairs = re.findall(r"(\w+) ([A-Z]+(?:\(\d+,\d+\))?)", fields)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TRADE = record_schema(TRADE_FIELDS)
LEDGER = record_schema(LEDGER_FIELDS)
LEDGER_JSON = record_schema(LEDGER_JSON_FIELDS)
STOCK_SNAPSHOT = record_schema(STOCK_SNAPSHOT_FIELDS)
FUND_SNAPSHOT = record_schema(FUND_SNAPSHOT_FIELDS)


def parse_delimited(df: DataFrame, schema: T.StructType, value: str = "value", sep: str = ",",
                    trim: bool = False) -> DataFrame:
    """Positional text record to typed columns; an unreadable field becomes NULL.

    The split is the only element of an exploded array: filters and projections above cannot be
    merged into a generator, so a record is split once however many of its fields are used.
    """
    pattern = "\\" + sep if len(sep) == 1 and not sep.isalnum() else f"\\Q{sep}\\E"
    parts = F.split(F.col(value).cast("string"), pattern, -1)
    out = df.withColumn("_parts", F.explode(F.array(parts)))

    def field(i: int, dtype: T.DataType) -> Column:
        raw = F.get(F.col("_parts"), F.lit(i))
        raw = F.trim(raw) if trim else raw
        if isinstance(dtype, T.StringType):
            return raw
        return F.nullif(raw, F.lit("")).try_cast(dtype)  # an empty field skips the cast: a failed one is slow

    keep = [c for c in df.columns if c != value]
    return out.select(*keep, *[field(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def format_delimited(values: dict[str, Column], schema: T.StructType, sep: str = ",") -> Column:
    """Text record of ``schema`` with the given fields set and the others empty.

    Runs of empty fields become one literal, which keeps the generated code small.
    """
    pieces: list[Column] = []
    literal = ""
    for i, name in enumerate(schema.names):
        literal += sep if i else ""
        if name in values:
            pieces += [F.lit(literal), F.coalesce(values[name].cast("string"), F.lit(""))]
            literal = ""
    return F.concat(*pieces, F.lit(literal))


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text or bytes to typed columns: bad JSON gives NULL fields, never an error.

    Parsed once per row, like :func:`parse_delimited`.
    """
    keep = [c for c in df.columns if c != value]
    parsed = df.withColumn("_json", F.explode(F.array(F.from_json(F.col(value).cast("string"), schema))))
    return parsed.select(*keep, "_json.*")


def ledger_decimals(df: DataFrame) -> DataFrame:
    """Type the decimal columns that a JSON ledger record carries as text."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in LEDGER_JSON_DECIMALS.items() if c in df.columns})


def with_fallback(fields: dict[str, Column], default: dict[str, Column]) -> list[Column]:
    """All parsed fields, or the whole default record when any field is unreadable."""
    broken = F.lit(False)
    for col in fields.values():
        broken = broken | col.isNull()
    return [F.when(broken, default[n]).otherwise(c).alias(n) for n, c in fields.items()]


def row_json() -> Column:
    """All columns as one JSON text; NULL fields are left out."""
    return F.to_json(F.struct("*"))


def non_null_map(*names: str) -> Column:
    """Map of column name to text value without the NULL ones."""
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
