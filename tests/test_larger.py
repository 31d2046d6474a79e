"""Queries whose results or costs went wrong on larger tables."""

import datetime as dt
import glob
import os
import time

from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracle import compare
from millrace.functions.records import TRADE, parse_delimited
from millrace.operators import statistics as st
from millrace.operators.theta import BLOCK_ROWS, Side, ThetaPlan, meet, plan_theta, theta_join
from millrace.plans import balances
from millrace.session import materialize, release
from millrace.streaming.run import retained
from millrace.workload import streams


def folder(tmp_path, **tables):
    """A data folder with the given tables."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def against_sql(spark, tmp_path, name, *tables):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    return compare(entry.queries()[name](spark, str(tmp_path)), con, entry.oracle_sql()[name])


def test_every_estimate_of_many_values_keeps_the_bound(spark, tmp_path):
    """6,000 suppliers; a sketch of five rows broke the bound for some."""
    suppliers = spark.range(600_000).select((F.col("id") % 6000).alias("l_suppkey"))
    folder(tmp_path, lineitem=suppliers.unionByName(spark.range(3).select(F.lit(None).cast("bigint").alias("l_suppkey"))))
    assert against_sql(spark, tmp_path, "stat_cms", "lineitem") == ""


def test_sketch_shape_follows_the_number_of_values():
    depths = [st.cms_shape(1e-4, n)[0] for n in (1, 10 ** 3, 10 ** 6, 10 ** 9)]
    assert depths == sorted(depths) and depths[0] < depths[-1] <= 12
    assert st.cms_shape(1e-4, 0)[0] >= 1


def test_last_click_of_a_stream_join_comes_out(spark, tmp_path):
    """the last click is later than the last view, and no view matches it."""
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(minutes=i), i % 7, ("click", "view", "error")[i % 3]) for i in range(300)]
    events.append((300, events[-1][1] + dt.timedelta(minutes=5), 9, "click"))
    folder(tmp_path, events=spark.createDataFrame(events, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"))
    assert against_sql(spark, tmp_path, "stream_stream_left", "events") == ""


def trade(no, day, flag="03"):
    fields = {"serverid": "1", "matchsno": str(no), "fundid": "7", "orgid": "0001", "secuid": "A7", "bsflag": flag, "matchtype": "0",
              "market": "O", "stkcode": "000001", "matchqty": "5", "trddate": str(day)}
    return ",".join(fields.get(n, "") for n in TRADE.names)


def test_only_messages_that_move_a_balance_are_compared(spark, tmp_path):
    """the state holds no digest of a trade that is filtered out; repeats count once, in a stream and in a batch."""
    texts = [trade(i, 19980101 + i % 4, ("03", "0S", "XX")[i % 3]) for i in range(60)]
    lines = spark.createDataFrame([(t,) for t in texts + texts[::2]], "value STRING")
    path, per_trigger = streams.stage(lines, "lines", "text")
    stream = spark.readStream.option("maxFilesPerTrigger", per_trigger).text(path)
    query = balances.distinct_deltas(stream, 19980101).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
        "checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    want = sorted(balances.stock_deltas(lines.distinct().transform(parse_delimited, TRADE), 19980101).collect())
    assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == want
    assert sorted(balances.distinct_deltas(lines, 19980101).collect()) == want
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == len(want) < len(texts)


def test_expiring_digests_hand_on_no_text(spark):
    """the text is compared, and only the columns asked for are shuffled."""
    stream = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS message", "timestamp AS day", "value AS n")
    assert balances.distinct_within(stream, F.col("day"), value="message", keep=["n"]).columns == ["n"]


def test_texts_are_read_once_for_all_batches(spark, small):
    """the seed and the batches come from written changes, not from the texts once more."""
    plan = streams.balance_compacted(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_staged_files_do_not_grow_with_the_table(spark, monkeypatch):
    """F8: a task writes a file of a bounded number of rows, however many there are."""
    monkeypatch.setattr(streams, "FILE_ROWS", 50)
    path, per_trigger = streams.stage(spark.range(3000), "bounded")
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert per_trigger == 20 and len(sizes) == 60 and max(sizes) <= 60 and sum(sizes) == 3000


def test_theta_join_writes_no_matches(spark):
    """matches may be as many as pairs of rows; what is written grows with the sides alone."""
    left, right = spark.range(400).select("id", (F.col("id") % 100).alias("a")), spark.range(400).select("id", (F.col("id") + 50).alias("b"))
    joined = theta_join(left, right, [("a", "<", "b"), ("id", ">=", "id")])
    root = spark.conf.get("spark.checkpoint.dir")
    assert not glob.glob(f"{root}/theta-pairs-*") and joined.count() > 70_000
    newest = max(glob.glob(f"{root}/theta-matched-*"), key=os.path.getmtime)
    assert spark.read.parquet(newest).count() <= 400


def test_theta_join_repeats_rows_in_proportion(spark):
    """a left row is repeated per chunk of what it can match, not per cell, and more rows do not make more cells."""
    def met(n):
        side = lambda seed: spark.range(n).select("id", F.rand(seed).alias("x"), F.rand(seed + 1).alias("y"))
        plan = plan_theta(side(1), side(5), [("x", ">", "x"), ("y", "<", "y")])
        assert len(plan.pairs) > 10 * len(plan.left.cells)
        return meet(plan, BLOCK_ROWS)

    small, large = met(4_000), met(32_000)
    assert {len(keys) for _, keys in small.left.values()} == {len(keys) for _, keys in large.left.values()} == {1}
    assert large.rows < 8 * 1.2 * small.rows


def test_keys_of_a_theta_join_bring_each_pair_of_blocks_together_once():
    """whatever the sizes, a left and a right block of matching cells share one key, and a chunk is bounded."""
    sizes = lambda *n: Side(None, {c: {"n": x} for c, x in enumerate(n)})
    plan = ThetaPlan(sizes(5, 25, 10), sizes(3, 4, 31, 1), [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (1, 3), (2, 3)])
    found = meet(plan, 10)
    for i, j in ((i, j) for i in plan.left.cells for j in plan.right.cells):
        own, firsts = found.left[i]
        for block in range(own):
            for keys in found.right.get(j, (0, []))[1]:
                assert len({first + block for first in firsts} & set(keys)) == ((i, j) in plan.pairs)
    held = {}
    for j, (n, blocks) in found.right.items():
        for keys in blocks:
            for key in keys:
                held[key] = held.get(key, 0) + -(-plan.right.cells[j]["n"] // n)
    assert max(held.values()) <= 10
    assert found.rows == sum(plan.left.cells[i]["n"] * len(f) for i, (_, f) in found.left.items()) + sum(
        plan.right.cells[j]["n"] * found.left[i][0] for i, j in plan.pairs)


def test_ordered_rows_are_dealt_without_what_is_made_of_them(spark):
    """texts and copies are made after the shuffle, and larger tables have more batches of bounded size."""
    lines = spark.range(4_000).select("id", (F.col("id") * 7 % 4_000).alias("day"))
    plans = []

    def make(rows):
        made = rows.select("day", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"), F.concat(F.lit("text "), "id").alias("value"))
        plans.append(made._jdf.queryExecution().optimizedPlan().toString())
        return made

    path, per_batch = streams.stage_ordered(lines, "ordered", "day", make, batch_rows=700)
    assert len(plans) == 5 and all("concat(" in p and p.index("concat(") < p.index("Repartition") < p.index("Range") for p in plans)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count("*").alias("n")).collect()
    files = sorted(files, key=lambda r: r.a)
    assert per_batch == 4 and len(files) == 20 and sum(r.n for r in files) == 8_000
    batches = [files[i:i + 4] for i in range(0, 20, 4)]
    assert all(max(r.b for r in x) < min(r.a for r in y) for x, y in zip(batches, batches[1:]))


def test_a_stream_that_ends_keeps_the_state_asked_for(spark):
    """the checkpoint keeps few batches, and other streams keep the session's setting."""
    name = "spark.sql.streaming.minBatchesToRetain"
    before = spark.conf.get(name)
    with retained(spark, 2):
        assert spark.conf.get(name) == "2"
    assert spark.conf.get(name) == before


def test_shuffle_files_of_steps_that_are_through_are_removed(spark):
    """a job of many steps does not keep the shuffle files of all of them."""
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    for _ in range(3):
        materialize(spark.range(20_000).repartition(4, "id"), "step")
    before = held()
    release(spark)
    for _ in range(50):
        if held() < before:
            break
        time.sleep(0.2)
    assert held() < before
