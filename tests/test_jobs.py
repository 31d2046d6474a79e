import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import LEDGER_JSON
from millrace.plans import balances, bank_transfers, daily_sync, events, freshness
from millrace.sources import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- freshness -------------------------------------------------------------------------------


def test_latest_day_never_falls(spark):
    names = spark.createDataFrame([("t",)], "name STRING")
    ledger = None
    for i, (day, last, latest) in enumerate([("20200114", "20200114", "20200114"), ("20200110", "20200110", "20200114"),
                                             ("-1", "-1", "20200114")]):
        entry = freshness.feed_entries(names, F.lit(f"2020-02-0{i + 1} 06:00:00"), F.lit(day))
        ledger = entry if ledger is None else freshness.merge_ledger(ledger, entry)
        got = ledger.first()
        assert (got.rowkey, got.last_data_time, got.latest_data_time) == ("t_hbase", last, latest)


# --- balances --------------------------------------------------------------------------------


def _trades(spark, data):
    cols = "bsflag STRING, matchqty BIGINT, matchtype STRING, matchsno BIGINT, trddate BIGINT"
    df = spark.createDataFrame(data, cols)
    keys = {"fundid": F.lit(1).cast("bigint"), "secuid": F.lit("s"), "orgid": F.lit("o"), "market": F.lit("0"),
            "stkcode": F.lit("000709"), "serverid": F.lit(1).cast("bigint")}
    return df.withColumns(keys)


def test_signed_changes(spark):
    seed = spark.createDataFrame([("1_s_o_0_000709_1", 100)], "rowkey STRING, balance BIGINT")
    trades = _trades(spark, [("03", 10, "1", 1, 20200102), ("04", 30, "1", 2, 20200102), ("0B", 5, "1", 3, 20200102),
                             ("0S", 7, "0", 4, 20200102), ("zz", 99, "0", 5, 20200102), ("03", 1000, "0", 6, 20191231)])
    got = balances.running_balance(seed, balances.stock_deltas(trades, 20200101)).first()
    assert (got.balance, got.last_no, got.last_day) == (73, 4, 20200102)


def test_flags_are_case_sensitive(spark):
    flags = balances.ADD_FLAGS + balances.SUBTRACT_FLAGS
    assert len(flags) == len(set(flags)) == 19
    trades = _trades(spark, [("0B", 1, "0", 1, 1), ("0b", 2, "0", 2, 1), ("0s", 4, "0", 3, 1)])
    assert balances.sum_deltas(balances.stock_deltas(trades)).first().delta == 3


def test_replayed_batch_counts_once_and_compaction_keeps_balances(spark, tmp_path):
    seed = spark.createDataFrame([("k", 100)], "rowkey STRING, balance BIGINT")
    sink = balances.delta_sink(str(tmp_path / "d"))
    delta = lambda x, no: spark.createDataFrame([("k", x, no, 1)], "rowkey STRING, delta BIGINT, last_no BIGINT, last_day BIGINT")
    sink(delta(5, 1), 0)
    sink(delta(5, 1), 0)
    sink(delta(-2, 2), 1)
    path = str(tmp_path / "d")
    now = lambda: tuple(balances.balances_from(spark, seed, path).first())
    assert now() == ("k", 103, 2, 1)
    balances.compact(spark, path, 0)
    assert now() == ("k", 103, 2, 1)
    sink(delta(5, 1), 0)  # folded already
    sink(delta(10, 3), 2)
    assert now() == ("k", 113, 3, 1)
    balances.compact(spark, path, 2)
    balances.compact(spark, path, 1)  # an older cut changes nothing
    assert now() == ("k", 113, 3, 1)


def test_trades_without_a_key_are_rejected(spark):
    ddl = "fundid BIGINT, secuid STRING, orgid STRING, market STRING, stkcode STRING, serverid BIGINT, bsflag STRING, matchtype STRING, matchqty BIGINT, matchsno BIGINT, trddate BIGINT"
    trades = spark.createDataFrame([(1, "s", "o", "0", "c", 1, "03", "0", 10, 1, 1), (1, None, "o", "0", "c", 1, "03", "0", 20, 2, 1),
                                    (2, "s", "o", "0", None, 1, "03", "0", 30, 3, 1)], ddl)
    assert balances.sum_deltas(balances.stock_deltas(trades)).count() == 1
    assert sorted(r.matchsno for r in balances.rejects(trades, balances.STOCK_KEY).collect()) == [2, 3]


def test_rules_share_one_copy_of_the_orders(spark, small):
    from millrace.workload.jobs import business_events

    plan = business_events(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 0 and "orders-by-day" in plan


# --- events ----------------------------------------------------------------------------------

DAY = "20200302"


def _context(spark):
    make = spark.createDataFrame
    t = {
        "custbaseinfo": make([(1, "p1", DAY, 0), (2, "p2", DAY, 0), (3, "p3", DAY, 1), (4, "p4", "20190101", 0)],
                             "custid BIGINT, mobileno STRING, opendate STRING, singleflag INT"),
        "user_basic_info": make([(1, 1), (2, 0), (3, 1)], "user_code BIGINT, open_source INT"),
        "customer": make([(1, "org1")], "custid BIGINT, orgid STRING"),
        "oa_s_cczq": make([("1", " Ann "), ("2", "Bob")], "cust_code STRING, commender_name STRING"),
        "cgemsecuinfo": make([(2, "00", DAY), (2, "00", DAY), (4, "01", DAY)], "custid BIGINT, dealresult STRING, signdate STRING"),
        "cust_invest_pro": make([("4", "1", DAY)], "cust_code STRING, prof_investor_type STRING, prof_sign_date STRING"),
        "secuid": make([(1, "0w", 0, DAY, "5"), (1, "0s", 0, DAY, "S"), (1, "0s", 0, DAY, "5"), (2, "0s", 0, DAY, "9"),
                        (4, "05", 0, DAY, "1"), (4, "06", 1, DAY, "1")],
                       "custid BIGINT, securight STRING, status INT, opendate STRING, market STRING"),
        "opp_busi_data": make([("1", "D0008", "13", dt.datetime(2020, 3, 2, 23, 59)), ("1", "D0009", "13", dt.datetime(2020, 3, 3)),
                               ("2", "D0009", "12", dt.datetime(2020, 3, 2))],
                              "cust_code STRING, busi_code STRING, proc_status STRING, oper_time TIMESTAMP"),
        "cust_agreement": make([("1", "11", DAY), ("2", "26", DAY)], "cust_code STRING, cust_agmt_type STRING, eft_date STRING"),
        "private_fund_invest": make([("1", "1", DAY), ("2", "4", DAY), ("2", "4", DAY)],
                                    "cust_code STRING, fund_invest_type STRING, apply_date STRING"),
        "cdtapplication": make([(4, DAY, "5")], "custid BIGINT, effectivedate STRING, status STRING"),
        "opt_trdacct": make([("2", DAY)], "cust_code STRING, effect_date STRING"),
        "otc_auto_invest_agr": make([("1", "a1", 7, "1", DAY), ("2", "a2", 8, "1", DAY)],
                                    "cust_code STRING, app_sno STRING, inst_sno INT, agr_stat STRING, app_date STRING"),
        "otc_inst_base_info": make([(7, "F7")], "inst_sno INT, inst_id STRING"),
        "otc_ec_sign": make([("1", DAY, DAY, 9512, "0", dt.datetime(2020, 3, 2)),
                             ("2", DAY, DAY, 9512, "0", dt.datetime(2020, 3, 2)), ("2", DAY, "20200101", 9513, "1", dt.datetime(2020, 3, 2)),
                             ("4", DAY, DAY, 9512, "0", dt.datetime(2020, 3, 2)), ("4", DAY, "20200101", 9512, "1", dt.datetime(2020, 3, 2))],
                            "cust_code STRING, busi_date STRING, sign_date STRING, inst_sno INT, sign_stat STRING, upd_timestamp TIMESTAMP"),
        "eccustsign": make([(1, 20200302), (1, 20200302)], "custid BIGINT, orderdate INT"),
        "otc_trd_orders": make([("4", DAY, 20200302, "129", "0"), ("4", DAY, 20200302, "129", "1")],
                               "cust_code STRING, busi_date STRING, app_date INT, trd_id STRING, div_method STRING"),
        "logbanktran": make([(1, DAY, "1", "2"), (2, DAY, "1", "2"), (4, DAY, "1", "3")],
                            "custid BIGINT, busi_date STRING, banktranid STRING, status STRING"),
        "logbanktran_margin": make([(2, "20200220", "1", "2"), (1, "20191231", "1", "2")],
                                   "custid BIGINT, busi_date STRING, banktranid STRING, status STRING"),
    }
    return events.EventContext(t, DAY, ("Ann",))


EXPECTED = {
    "010109": ["1"], "010110": ["1"], "010201": ["2", "2"], "010301": ["4"], "010401": ["1"], "010501": ["1"], "010601": [],
    "010701": ["1"], "010801": ["1"], "010901": ["2"], "011001": ["1", "2"], "011101": ["4"], "011201": ["4"], "011301": ["2"],
    "011401": ["1", "2"], "011403": ["1"], "011404": ["2"], "011405": ["1"], "011406": ["4"], "011407": ["2"], "012101": ["1"],
}


def test_rules(spark):
    ctx = _context(spark)
    found = events.with_customer(events.candidates(ctx), events.individual_customers(ctx)).collect()
    by_code = {code: sorted(r.cust_id for r in found if r.busi_no == code) for code in events.RULE_CODES}
    assert by_code == EXPECTED
    pick = lambda code, cust: next(r for r in found if r.busi_no == code and r.cust_id == cust)
    assert (pick("010109", "1").orgid, pick("010110", "1").commender_name) == ("org1", " Ann ")
    assert pick("011001", "1").market == "both" and pick("011001", "2").market is None
    assert (pick("011401", "1").fundcode, pick("011401", "2").fundcode) == ("F7", None)


def test_events_go_out_once(spark, tmp_path):
    ctx = _context(spark)
    ledger, out = str(tmp_path / "ledger"), str(tmp_path / "messages")
    events.publish(ctx, ledger, out)
    sent = spark.read.parquet(out)
    total = sum(len(set(v)) for v in EXPECTED.values())
    assert sent.count() == total == spark.read.parquet(ledger).count()
    assert sent.where("key = '1_20200302_010109'").first().value == (
        '{"cust_id":"1","cust_telno":"p1","busi_no":"010109","busi_date":"20200302","orgid":"org1"}')
    events.publish(ctx, ledger, out)
    assert spark.read.parquet(out).count() == total == spark.read.parquet(ledger).count()


# --- transfers -------------------------------------------------------------------------------


def test_transfer_text_rows(spark):
    good = '{"sno":5,"custid":77,"fundid":60210007,"custname":" Li ","digestid":160021,"operdate":20200101,"bizdate":20200102}'
    df = spark.createDataFrame([(good,), ('{"digestid":1}',), ("{bad",), ('{"fundid":123,"digestid":140057}',)], "value STRING")
    got = {r.cptl_acid: r for r in bank_transfers.transfer_rows(df).collect()}
    assert set(got) == {"60210007", "123"}
    assert got["60210007"].rowkey == "70001206_20200101_20200102_5" and got["60210007"].cust_name == "Li"
    assert got["123"].reverse_cptl_acid == "321" and got["123"].brch_id == ""
    assert len(bank_transfers.OUTPUT_COLUMNS) == 13 and len(LEDGER_JSON) == 83


# --- daily sync ------------------------------------------------------------------------------


def test_sync_writes_a_folder_per_target(spark, tmp_path):
    df = spark.createDataFrame([("1", "20200101", decimal.Decimal("1.50")), ("2", "20200102", None)],
                               "id STRING, busi_date STRING, amount DECIMAL(10,2)")
    specs = [daily_sync.SyncSpec("a", ("id", "busi_date"), "busi_date"), daily_sync.SyncSpec("b", ("id",), None, "target_b")]
    paths = daily_sync.daily_sync(lambda _: df, specs, "20200101", str(tmp_path))
    assert [p.split("/")[-2] for p in paths] == ["a", "target_b"]
    assert rows(spark.read.parquet(paths[0]).select("rowkey", "qualifier", "value")) == [
        ("1_20200101", "amount", "1.50"), ("1_20200101", "busi_date", "20200101"), ("1_20200101", "id", "1")]
    assert spark.read.parquet(paths[1]).count() == 5
    assert sum(len(s) for s in daily_sync.SYNC_JOBS.values()) == 15


def test_sync_enters_the_ledger(spark, tmp_path):
    df = spark.createDataFrame([("1", "20200101")], "id STRING, busi_date STRING")
    spec = daily_sync.SyncSpec("a", ("id",), "busi_date")
    names = spark.createDataFrame([("a",)], "name STRING")
    old = freshness.feed_entries(names, F.lit("2020-01-01 06:00:00"), F.lit("20200105"))
    got = daily_sync.sync_and_record(lambda _: df, [spec], "20200101", str(tmp_path), old, F.lit("2020-01-06 06:00:00")).first()
    assert (got.rowkey, got.last_data_time, got.latest_data_time) == ("a_hbase", "20200101", "20200105")


# --- incremental reads -----------------------------------------------------------------------


def _offsets(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "o BIGINT")


def test_poll_golden(spark, tmp_path):
    batches = []
    handle = lambda df, i: batches.append((i, [r.o for r in df.orderBy("o").collect()]))
    state = str(tmp_path / "state")
    assert incremental.poll(_offsets(spark, 1, 2, 3, 4, 5, None), "o", state, handle, "3")
    assert incremental.poll(_offsets(spark, 1, 2, 3, 4, 5, 6, 7), "o", state, handle, "3")
    assert not incremental.poll(_offsets(spark, 1, 2, 3, 4, 5, 6, 7), "o", state, handle, "3")
    assert batches == [(0, [3, 4, 5]), (1, [6, 7])]


def test_poll_latest_and_empty(spark, tmp_path):
    got = []
    assert not incremental.poll(_offsets(spark).where("o IS NOT NULL"), "O", str(tmp_path / "e"), lambda df, i: got.append(i))
    incremental.poll(_offsets(spark, 1, 5), "O", str(tmp_path / "l"), lambda df, i: got.extend(r.o for r in df.collect()), "latest")
    assert got == [5]


def test_poll_replays_an_unfinished_batch(spark, tmp_path):
    state, seen = str(tmp_path / "state"), []

    def fail(df, i):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        incremental.poll(_offsets(spark, 1, 2), "o", state, fail)
    incremental.poll(_offsets(spark, 1, 2, 3), "o", state, lambda df, i: seen.append((i, df.count())))
    incremental.poll(_offsets(spark, 1, 2, 3), "o", state, lambda df, i: seen.append((i, df.count())))
    assert seen == [(0, 2), (1, 1)]


def test_unknown_offset_column(spark):
    with pytest.raises(ValueError):
        incremental.offset_bounds(_offsets(spark, 1), "nope")


def test_range_is_pushed_into_the_scan(spark, small):
    o = spark.read.parquet(f"{small}/orders.parquet")
    plan = incremental.offset_slice(o, "o_orderkey", 5, 9, False)._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderkey,5)" in plan and "LessThanOrEqual(o_orderkey,9)" in plan
