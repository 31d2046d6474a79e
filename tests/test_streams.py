import datetime as dt
import os

from pyspark.sql import functions as F

from millrace.functions import records
from millrace.plans import balances
from millrace.sinks.writers import RowWriter, batch_folder_sink
from millrace.sources import files, incremental
from millrace.streaming import operators as so
from millrace.streaming.run import run_available_now, run_foreach_batch, start_continuous

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(spark, folder, data, schema):
    """One more file in the stream's input folder."""
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))


def source(spark, folder, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(str(folder))


NAMED = "name STRING, age BIGINT, time TIMESTAMP"


def test_late_rows_are_dropped(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "out")
    run = lambda: run_available_now(so.dedup_forever(source(spark, inp, NAMED), "time", "10 seconds", ["name"]), "append", ck, out)
    put(spark, inp, [("a", 1, at(0)), ("a", 2, at(1)), ("b", 1, at(100))], NAMED)
    run()
    put(spark, inp, [("late", 1, at(5)), ("c", 1, at(95)), ("b", 9, at(101))], NAMED)
    assert sorted(r.name for r in run().collect()) == ["a", "b", "c"]


def test_bounded_dedup_forgets(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "out")
    run = lambda: run_available_now(so.dedup_within(source(spark, inp, NAMED), "time", "10 seconds", ["name"]), "append", ck, out)
    put(spark, inp, [("a", 1, at(0)), ("a", 2, at(1))], NAMED)
    assert run().count() == 1
    put(spark, inp, [("x", 1, at(200))], NAMED)
    run()
    put(spark, inp, [("a", 3, at(201))], NAMED)
    assert sorted(r.name for r in run().collect()) == ["a", "a", "x"]


LEFT, RIGHT = "name1 STRING, salary BIGINT, time1 TIMESTAMP", "name2 STRING, age BIGINT, time2 TIMESTAMP"


def test_left_outer_stream_join(spark, tmp_path):
    li, ri, ck, out = tmp_path / "l", tmp_path / "r", str(tmp_path / "ck"), str(tmp_path / "out")

    def run():
        joined = so.interval_stream_join(source(spark, li, LEFT), source(spark, ri, RIGHT), ("name1", "name2"),
                                         ("time1", "time2"), ("10 seconds", "15 seconds"), 20, "leftOuter")
        return run_available_now(joined, "append", ck, out)

    put(spark, li, [("a", 1, at(20)), ("b", 1, at(20)), ("c", 1, at(30)), ("d", 1, at(30))], LEFT)
    put(spark, ri, [("a", 7, at(10)), ("c", 7, at(10)), ("d", 8, at(30))], RIGHT)
    run()
    put(spark, li, [("flush", 0, at(9000))], LEFT)
    put(spark, ri, [("flush2", 0, at(9000))], RIGHT)
    run()
    got = [(r.name1, r.age) for r in run().collect() if r.name1 != "flush"]
    # a matches; c is exactly 20 seconds later and does not; d is at the same time and does.
    assert sorted(got, key=str) == [("a", 7), ("b", None), ("c", None), ("d", 8)]


def test_sliding_windows_stream_equals_batch(spark, tmp_path):
    schema = "word STRING, ts TIMESTAMP"
    data = [("x" if i % 3 else "y", at(i * 7)) for i in range(60)]
    for part in (data[:20], data[20:40], data[40:]):
        put(spark, tmp_path / "in", part, schema)
    stream = so.windowed_count(source(spark, tmp_path / "in", schema, maxFilesPerTrigger=1), "ts", "word", "30 seconds", "10 seconds")
    batch = so.windowed_count(spark.createDataFrame(data, schema), "ts", "word", "30 seconds", "10 seconds")
    assert rows(run_available_now(stream, "complete")) == rows(batch)


def test_running_count_of_people(spark, tmp_path):
    (tmp_path / "people").mkdir()
    (tmp_path / "people" / "p.csv").write_text(
        "name;age;job\nIlse;35;Smith\nTom;27;Baker\nAda;18;Baker\nKofi;61;Smith\nRuth;39;Baker\n")
    stream = spark.readStream.option("sep", ";").option("header", True).schema("name STRING, age INT, job STRING").csv(str(tmp_path / "people"))
    assert rows(run_available_now(so.running_count(stream, "job"), "complete")) == [("Baker", 3), ("Smith", 2)]
    assert rows(run_available_now(stream.select("name", "age").where("age > 30").select("name"))) == [("Ilse",), ("Kofi",), ("Ruth",)]


def test_no_input_gives_no_rows(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    stream = source(spark, tmp_path / "empty", NAMED)
    assert run_available_now(so.running_count(stream, "name"), "complete").count() == 0


def test_restart_continues_where_it_stopped(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "deltas")
    schema = "rowkey STRING, delta BIGINT, last_no BIGINT, last_day BIGINT"
    seed = spark.createDataFrame([("k", 100)], "rowkey STRING, balance BIGINT")

    def run():
        run_foreach_batch(source(spark, inp, schema, maxFilesPerTrigger=1), balances.delta_sink(out), ck)
        return balances.balances_from(spark, seed, out).first().balance

    put(spark, inp, [("k", 5, 1, 1)], schema)
    assert run() == 105
    assert run() == 105
    put(spark, inp, [("k", -7, 2, 1), ("k", 1, 3, 1)], schema)
    assert run() == 99


def test_failed_batch_is_replayed_once(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "deltas")
    schema = "rowkey STRING, delta BIGINT, last_no BIGINT, last_day BIGINT"
    put(spark, inp, [("k", 5, 1, 1)], schema)
    sink = balances.delta_sink(out)

    def crash_after_write(df, i):
        sink(df, i)
        raise RuntimeError("lost")

    try:
        run_foreach_batch(source(spark, inp, schema), crash_after_write, ck)
    except Exception:
        pass
    run_foreach_batch(source(spark, inp, schema), sink, ck)
    seed = spark.createDataFrame([("k", 100)], "rowkey STRING, balance BIGINT")
    assert balances.balances_from(spark, seed, out).first().balance == 105


def test_refreshing_lookup(spark):
    clock, loads = [0.0], []

    def load():
        loads.append(clock[0])
        return spark.createDataFrame([(len(loads),)], "version INT")

    lookup = so.RefreshingLookup(load, ttl=6, clock=lambda: clock[0])
    seen = []
    for now in (0, 3, 6, 7, 14):
        clock[0] = float(now)
        seen.append(lookup.current().first().version)
    assert seen == [1, 1, 1, 2, 3]


def test_row_writer(spark, tmp_path):
    target = str(tmp_path / "rows")
    os.makedirs(target)

    def connect(partition_id, epoch_id):
        class Target:
            def __init__(self):
                self.file = open(f"{target}/{partition_id}-{epoch_id}", "w")

            def write(self, row):
                self.file.write(row.word + "\n")

            def close(self):
                self.file.close()

        return Target()

    put(spark, tmp_path / "in", [("a",), ("b",), ("c",)], "word STRING")
    stream = source(spark, tmp_path / "in", "word STRING")
    (stream.writeStream.foreach(RowWriter(connect)).option("checkpointLocation", str(tmp_path / "ck"))
     .trigger(availableNow=True).start().awaitTermination())
    words = [w for f in os.listdir(target) for w in open(f"{target}/{f}").read().split()]
    assert sorted(words) == ["a", "b", "c"]


def test_processing_time_trigger(spark, tmp_path):
    put(spark, tmp_path / "in", [("a",)], "word STRING")
    seen = []
    query = start_continuous(source(spark, tmp_path / "in", "word STRING"), lambda df, i: seen.append(df.count()),
                             str(tmp_path / "ck"), "200 milliseconds", "named_query")
    try:
        assert query.name == "named_query"
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == [1]


def test_polls_in_slices_lose_nothing(spark, tmp_path):
    path, state, out = (str(tmp_path / x) for x in ("t", "state", "out"))
    spark.range(1000).select(F.col("id").alias("o")).repartitionByRange(4, "o").write.parquet(path)
    polls = 0
    while incremental.poll(spark.read.parquet(path), "o", state, batch_folder_sink(out), max_rows=300):
        polls += 1
    assert polls == 4 and len(list((tmp_path / "state").glob("batch=*"))) == polls
    assert all(len(list(folder.glob("*.json"))) == 1 for folder in (tmp_path / "state").glob("batch=*"))
    got = spark.read.parquet(out)
    assert sorted(r.o for r in got.collect()) == list(range(1000))
    assert got.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 310


def test_offset_range_reaches_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("o")).write.parquet(str(tmp_path / "t"))
    rows_after = incremental.offset_slice(spark.read.parquet(str(tmp_path / "t")), "o", 10, 20, inclusive=False)
    plan = rows_after._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o,10)" in plan and "LessThanOrEqual(o,20)" in plan


def test_lines_carry_their_arrival_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x y x\n\n")
    lines = files.read_line_stream(spark, str(tmp_path / "in"))
    counted = so.windowed_count(so.words(lines, "value", "timestamp"), "timestamp", "word", "30 seconds", "10 seconds")
    got = run_available_now(counted, "complete").groupBy("word").agg(F.sum("n").alias("n"), F.count("*").alias("windows"))
    assert rows(got) == [("", 3, 3), ("x", 6, 3), ("y", 3, 3)]


def test_repeated_message_counts_once_over_batches(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "deltas")
    values = lambda no: {"fundid": F.lit(1), "secuid": F.lit("s"), "orgid": F.lit("o"), "market": F.lit("0"), "stkcode": F.lit("c"),
                         "serverid": F.lit(1), "bsflag": F.lit("03"), "matchqty": F.lit(10), "matchsno": F.lit(no), "trddate": F.lit(20200102)}
    line = lambda no: spark.range(1).select(records.format_delimited(values(no), records.TRADE)).first()[0]

    def run():
        trades = source(spark, inp, "value STRING").transform(balances.distinct_messages).transform(records.parse_delimited, records.TRADE)
        run_foreach_batch(balances.stock_deltas(trades, 20200101), balances.delta_sink(out), ck)
        return balances.delta_store(out).read(spark).agg(F.sum("delta")).first()[0]

    put(spark, inp, [(line(1),), (line(1),), (line(2),)], "value STRING")
    assert run() == 20
    put(spark, inp, [(line(2),), (line(3),)], "value STRING")
    assert run() == 30


def test_update_mode_gives_the_changed_rows_of_each_batch(spark, tmp_path):
    inp, ck, out = tmp_path / "in", str(tmp_path / "ck"), str(tmp_path / "out")
    run = lambda: run_available_now(so.running_count(source(spark, inp, "word STRING"), "word"), "update", ck, out)
    put(spark, inp, [("a",), ("b",)], "word STRING")
    run()
    put(spark, inp, [("a",)], "word STRING")
    assert rows(run().select("word", "n", "batch_id")) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 0)]
