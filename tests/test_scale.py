"""Joins on inequalities, global order, stores and sources of our own: results against brute force, and how they get them."""

import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import statistics as st
from millrace.operators.cells import ranged_cell_store
from millrace.operators.ordered import blocks_in_order, running_totals, with_position
from millrace.operators.theta import plan_theta, theta_join
from millrace.plans import balances
from millrace.sinks import committed
from millrace.sinks.buckets import BucketStore
from millrace.sinks.folded import AGAIN, FoldedBatches
from millrace.sinks.writers import JsonLines, RowWriter, batch_folder_sink
from millrace.sources import offset_stream
from millrace.streaming.run import run_observed
from millrace.workload.relational import join_theta_large, sort_positions

OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Joins on inequalities -------------------------------------------------------------------------------------


def brute_theta(left, right, conditions, how):
    out = []
    for a in left:
        hits = [b for b in right if all(a[x] is not None and b[y] is not None and OPS[op](a[x], b[y]) for x, op, y in conditions)]
        out += [(a[0], b[0]) for b in hits] or ([(a[0], None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("ops", [(">", "<"), ("<=", ">="), ("<", "<")])
def test_theta_join_equals_brute_force(spark, ops):
    rng = random.Random(str(ops))
    # A third of each side has one value, some have none, and there are repeats.
    side = lambda n: [(i, rng.choice([5, rng.randrange(12), None, rng.randrange(12)]), rng.choice([7.5, rng.random() * 9, None])) for i in range(n)]
    left, right = side(90) + [(0, 5, 7.5)], side(70)
    l = spark.createDataFrame(left, "id int, a int, b double")
    r = spark.createDataFrame(right, "id int, a int, b double")
    for conditions in ([("a", ops[0], "a"), ("b", ops[1], "b")], [("b", ops[0], "b")]):
        named = [({"a": 1, "b": 2}[x], op, {"a": 1, "b": 2}[y]) for x, op, y in conditions]
        for how in ("inner", "left"):
            found = theta_join(l, r, conditions, how, ranges=4, block_rows=10).select("l.id", F.col("r.id").alias("other"))
            assert rows(found) == brute_theta(left, right, named, how)


def test_theta_join_compares_few_pairs(spark):
    """Two points a row that hardly meet: most cells are told apart by their smallest and largest values."""
    l = spark.range(20_000).selectExpr("id", "id AS x", "id AS y")
    r = spark.range(20_000).selectExpr("id", "id + 10 AS x", "id - 10 AS y")
    plan = plan_theta(l, r, [("x", ">", "x"), ("y", "<", "y")])
    assert plan.possible == 400_000_000 and plan.compared < plan.possible / 8
    assert theta_join(l, r, [("x", ">", "x"), ("y", "<", "y")], "inner").count() == 0


def test_theta_join_has_no_nested_loop(spark, small):
    plan = plan_of(join_theta_large(spark, small))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_theta_join_of_other_types_and_empty_sides(spark):
    day = lambda n: dt.date(2024, 1, n)
    l = spark.createDataFrame([(1, day(2), dt.datetime(2024, 1, 2)), (2, None, None)], "id int, d date, t timestamp")
    r = spark.createDataFrame([(1, day(1), dt.datetime(2024, 1, 3)), (2, day(2), dt.datetime(2024, 1, 1))], "id int, d date, t timestamp")
    found = theta_join(l, r, [("d", ">", "d"), ("t", "<", "t")]).select("l.id", F.col("r.id").alias("o"))
    assert rows(found) == [(1, 1), (2, None)]
    assert theta_join(l, r.limit(0), [("d", ">", "d")]).where("r IS NULL").count() == 2
    assert theta_join(l.limit(0), r, [("d", ">", "d")]).count() == 0
    with pytest.raises(ValueError):
        theta_join(l, r, [("d", "=", "d")])
    with pytest.raises(ValueError):
        theta_join(l.withColumn("s", F.lit("x")), r.withColumn("s", F.lit("y")), [("s", "<", "s")])


# Global order ----------------------------------------------------------------------------------------------


def test_positions_and_totals_of_skewed_rows(spark):
    rng = random.Random(1)
    data = [(rng.choice(["hot", "hot", f"k{rng.randrange(5)}", None]), rng.choice([1, 1, rng.randrange(9), None]), rng.choice([2, -1, None])) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, o int, v long").repartition(5)
    order = sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0] is not None, r[0] or ""))
    found = with_position(df, [F.desc_nulls_first("o"), "k"], partitions=7).orderBy("position").collect()
    assert [r.position for r in found] == list(range(1, 401))
    assert [(r.o, r.k) for r in found] == [(o, k) for k, o, _ in order]
    totals = running_totals(df, ["k"], ["o", "v"], "v", partitions=7)
    wanted, sums = [], {}
    for k, o, v in sorted(data, key=lambda r: (r[0] or "", r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0)):
        sums[k] = sums.get(k, 0) + (v or 0)
        wanted.append((k, o, v, sums[k]))
    assert rows(totals) == sorted(wanted, key=repr)


def test_a_hot_key_is_spread_over_blocks(spark):
    df = spark.range(40_000).selectExpr("'hot' AS k", "1 AS o", "1L AS v")
    sizes = [r["count"] for r in blocks_in_order(df, ["k", "o"], 8).groupBy("_block").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 12_000
    assert running_totals(df, ["k"], ["o"], "v", partitions=8).agg(F.max("total"), F.countDistinct("total")).first()[:] == (40_000, 40_000)


def test_empty_order(spark):
    df = spark.createDataFrame([], "k string, o int, v long")
    assert with_position(df, ["o"]).count() == 0 and running_totals(df, ["k"], ["o"], "v").count() == 0


def test_positions_need_no_single_task(spark, small):
    assert "SinglePartition" not in plan_of(sort_positions(spark, small))


def test_sketches_merge(spark):
    df = spark.range(100_000).selectExpr("id % 2 AS g", "id % 10 AS day", "double(id) AS x").unionByName(
        spark.createDataFrame([(0, 1, None), (0, 1, float("nan"))], "g long, day long, x double"))
    stored = st.value_sketches(df, "x", ["g", "day"])
    assert stored.count() == 10
    some = st.merged_quantiles(stored.where("day < 4"), ["g"], [0.0, 0.5, 1.0]).collect()
    assert all(r.n == 20_000 for r in some)
    assert all(abs(r.value - r.prob * 100_000) < 1_500 for r in some)


# Stores ----------------------------------------------------------------------------------------------------

DELTA = "rowkey STRING, delta BIGINT, last_no BIGINT, last_day BIGINT"


def delta(spark, *changes, day=1):
    return spark.createDataFrame([(k, v, n, day) for n, (k, v) in enumerate(changes)], DELTA)


def held(spark, path):
    none = spark.createDataFrame([], "rowkey STRING, balance BIGINT")
    return {r.rowkey: r.balance for r in balances.balances_from(spark, none, path).collect()}


def test_a_new_checkpoint_is_no_replay(spark, tmp_path):
    path = str(tmp_path / "d")
    store = balances.delta_store(path)
    old, new = store.sink(run="first"), store.sink(run="second")
    old(delta(spark, ("k", 100)), 0)
    old(delta(spark, ("k", 11)), 1)
    store.compact(spark, 1)
    old(delta(spark, ("k", 11)), 1)
    assert held(spark, path) == {"k": 111}
    new(delta(spark, ("k", 7)), 0)
    new(delta(spark, ("k", 7)), 0)
    assert held(spark, path) == {"k": 118}
    store.compact(spark, 0)
    new(delta(spark, ("k", 7)), 0)
    assert held(spark, path) == {"k": 118}
    with pytest.raises(ValueError, match="followed"):
        old(delta(spark, ("k", 1)), 2)


def test_unfolded_batches_of_a_lost_run_are_kept(spark, tmp_path):
    path = str(tmp_path / "d")
    store = balances.delta_store(path)
    store.sink(run="first")(delta(spark, ("k", 1)), 0)
    store.sink(run="second")(delta(spark, ("k", 2)), 0)
    assert held(spark, path) == {"k": 3}
    store.compact(spark, 0)
    assert held(spark, path) == {"k": 3}


def test_a_run_that_starts_again_replaces_the_lost_one(spark, tmp_path):
    path = str(tmp_path / "d")
    store = FoldedBatches(path, balances.sum_deltas, AGAIN)
    store.sink(run="first")(delta(spark, ("k", 5), ("gone", 1)), 0)
    store.compact(spark, 0)
    store.sink(run="first")(delta(spark, ("k", 6)), 1)
    store.sink(run="second")(delta(spark, ("k", 9)), 0)
    assert {r.rowkey: r.delta for r in store.read(spark).collect()} == {"k": 9}
    store.compact(spark, 0)
    store.sink(run="second")(delta(spark, ("k", 1)), 1)
    assert {r.rowkey: r.delta for r in store.read(spark).collect()} == {"k": 10}


def test_the_start_day_guards_the_seed(spark, tmp_path):
    path = str(tmp_path / "d")
    sink = balances.delta_sink(path, after_day=10)
    sink(delta(spark, ("k", 5), day=10).unionByName(delta(spark, ("k", 2), day=11)), 0)
    assert held(spark, path) == {"k": 2}


def test_a_stream_names_its_run(spark, tmp_path):
    inp, path = str(tmp_path / "in"), str(tmp_path / "d")
    for i, checkpoint in enumerate(("a", "a", "b")):
        delta(spark, ("k", 10 ** i)).coalesce(1).write.mode("append").parquet(inp)
        stream = spark.readStream.schema(DELTA).parquet(inp)
        (stream.writeStream.foreachBatch(balances.delta_sink(path)).option("checkpointLocation", str(tmp_path / checkpoint))
         .trigger(availableNow=True).start().awaitTermination())
    # The third stream has a checkpoint of its own and reads all files once more.
    assert held(spark, path) == {"k": 11 + 111}
    assert sorted(os.listdir(f"{path}/epochs")) == ["epoch=0", "epoch=1"]


def cell(spark, *values, version=1):
    return spark.createDataFrame([(k, "cf", "q", version, v) for k, v in values], "rowkey STRING, family STRING, qualifier STRING, v INT, value STRING")


def test_a_fold_rewrites_only_touched_ranges(spark, tmp_path):
    path = str(tmp_path / "r")
    store = ranged_cell_store(path, ["v"], ranges=8)
    write = store.sink()
    names = [f"{i:04d}" for i in range(400)]
    write(cell(spark, *[(k, "old") for k in names]), 0)
    store.compact(spark, 0)
    assert set(store.versions(spark).values()) == {0} and len(store.versions(spark)) >= 6
    write(cell(spark, ("0003", "new"), ("0005", "new"), ("zz", "added"), version=2), 1)
    now = lambda: {r.rowkey: r.value for r in store.read(spark).collect()}
    wanted = {**dict.fromkeys(names, "old"), "0003": "new", "0005": "new", "zz": "added"}
    assert now() == wanted
    store.compact(spark, 1)
    assert now() == wanted
    rewritten = glob.glob(f"{path}/data/version=1/range=*")
    assert len(rewritten) == 2 and list(store.versions(spark).values()).count(1) == 2
    write(cell(spark, ("0003", "lost"), version=3), 1)  # a replay of a folded batch
    store.compact(spark, 1)
    assert now() == wanted
    write(cell(spark, (None, "x"), ("0200", "older"), version=0), 2)
    store.compact(spark, 2)
    assert now() == {**wanted, None: "x"}


def test_point_look_up_reads_the_buckets_it_needs(spark, tmp_path):
    store = BucketStore(str(tmp_path / "b"), ["key"])
    store.create(spark.range(10_000).selectExpr("id AS key", "id * 2 AS value"), buckets=32)
    batch = spark.createDataFrame([(5,), (5,), (77,), (123_456,), (None,)], "key long")
    assert rows(store.look_up(batch)) == sorted([(5, 10), (5, 10), (77, 154), (123_456, None), (None, None)], key=repr)
    assert rows(store.look_up(batch, "inner")) == [(5, 10), (5, 10), (77, 154)]
    needed = store.rows_for(batch)
    assert "PartitionFilters: [bucket" in plan_of(needed)
    everything = glob.glob(str(tmp_path / "b" / "data" / "bucket=*"))
    read = {r[0] for r in needed.select(F.input_file_name()).distinct().collect()}
    assert len(read) <= 3 and len(everything) == 32
    assert needed.count() == 2  # keys are compared in the scan
    store.put_new(batch.selectExpr("key", "-1L AS value"))
    store.put_new(batch.selectExpr("key", "-2L AS value"))
    assert rows(store.look_up(batch, "inner")) == [(123_456, -1), (5, 10), (5, 10), (77, 154)]


def test_point_store_of_two_keys_and_of_nothing(spark, tmp_path):
    store = BucketStore(str(tmp_path / "b"), ["a", "b"])
    store.create(spark.createDataFrame([], "a string, b int, v string"), buckets=4)
    store.put_new(spark.createDataFrame([("x", 1, "u"), ("x", 1, "t"), ("x", None, "n")], "a string, b int, v string"))
    batch = spark.createDataFrame([("x", 1), ("y", 1)], "a string, b int")
    assert rows(store.look_up(batch)) == [("x", 1, "t"), ("y", 1, None)]
    assert rows(store.absent(batch)) == [("y", 1)]


# Sources and sinks of streams ------------------------------------------------------------------------------


def poll(spark, path, out, checkpoint, **options):
    stream = spark.readStream.format("offset_table").option("path", path).option("offsetcolumn", "pos").options(**options).load()
    query = stream.writeStream.foreachBatch(batch_folder_sink(out)).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def put(spark, path, low, high, name="x"):
    df = spark.range(low, high).selectExpr("id AS pos", f"'{name}' AS name", "timestamp_seconds(id) AS t")
    df.repartitionByRange(4, "pos").sortWithinPartitions("pos").write.mode("append").parquet(path)


def test_offset_source_restarts_where_it_stopped(spark, tmp_path):
    offset_stream.register(spark)
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    put(spark, path, 0, 1000)
    poll(spark, path, out, checkpoint, maxrows=300)
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.agg(F.countDistinct("pos")).first()[0] == 1000
    sizes = sorted(r["count"] for r in got.groupBy("batch_id").count().collect())
    assert len(sizes) == 4 and max(sizes) <= 300
    put(spark, path, 1000, 1500, "later")
    put(spark, path, 500, 510, "late, below the offset")
    poll(spark, path, out, checkpoint, maxrows=300)
    poll(spark, path, out, checkpoint)  # nothing new
    got = spark.read.parquet(out)
    assert got.count() == 1500 and got.agg(F.countDistinct("pos"), F.max("t")).first()[0] == 1500
    assert {r[0] for r in got.select("name").distinct().collect()} == {"x", "later"}


def test_offset_source_starts_where_it_is_told(spark, tmp_path):
    offset_stream.register(spark)
    path = str(tmp_path / "in")
    put(spark, path, 0, 100)
    for i, (start, n) in enumerate((("earliest", 100), ("latest", 1), ("40", 60))):
        poll(spark, path, str(tmp_path / f"out{i}"), str(tmp_path / f"ck{i}"), startingoffset=start)
        assert spark.read.parquet(str(tmp_path / f"out{i}")).count() == n


def test_offset_source_reads_only_row_groups_of_the_range(spark, tmp_path):
    path = str(tmp_path / "in")
    put(spark, path, 0, 1000)
    reader = offset_stream.OffsetTableReader({"path": path, "offsetcolumn": "pos"}, spark.read.parquet(path).schema)
    everything = reader.partitions({"offset": "0", "inclusive": True}, {"offset": "999", "inclusive": False})
    some = reader.partitions({"offset": "10", "inclusive": False}, {"offset": "20", "inclusive": False})
    assert len(everything) == 4 and len(some) == 1
    assert sum(b.num_rows for b in reader.read(some[0])) == 10


EVENT = "id BIGINT, name STRING"


def test_committed_sink_shows_whole_batches_only(spark, tmp_path):
    writer = committed.CommittedFilesWriter(str(tmp_path))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "name": ["a", None]})
    first, again = writer.write(iter([batch])), writer.write(iter([batch]))
    none = writer.write(iter([]))
    assert committed.read_committed(spark, str(tmp_path), EVENT).count() == 0
    writer.commit([first, none, None], 0)
    writer.commit([again], 0)  # the same batch once more
    assert rows(committed.read_committed(spark, str(tmp_path), EVENT)) == [(1, "a"), (2, None)]
    assert len(glob.glob(str(tmp_path / "data" / "*"))) == 1
    dropped = writer.write(iter([batch]))
    writer.abort([dropped, None], 1)

    def broken():
        yield batch
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    assert len(glob.glob(str(tmp_path / "data" / "*"))) == 1


def test_a_failed_task_leaves_no_row_twice(spark, tmp_path):
    """A row makes the first run fail after other tasks have written; the next run on the same checkpoint goes through."""
    committed.register(spark)
    inp, out, checkpoint, flag = (str(tmp_path / x) for x in ("in", "out", "ck", "fail"))
    spark.range(1000).selectExpr("id", "'n' AS name").repartition(4).write.parquet(inp)
    open(flag, "w").close()

    def check(batches):
        for b in batches:
            if os.path.exists(flag) and 777 in b.column("id").to_pylist():
                raise RuntimeError("lost")
            yield b

    def run():
        stream = spark.readStream.schema(EVENT).parquet(inp).mapInArrow(check, EVENT)
        query = (stream.writeStream.format("committed_files").option("path", out).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    assert committed.read_committed(spark, out, EVENT).count() == 0
    os.remove(flag)
    run()
    got = committed.read_committed(spark, out, EVENT)
    assert got.count() == 1000 and got.agg(F.countDistinct("id")).first()[0] == 1000


def test_expired_digests_leave_the_state(spark, tmp_path):
    inp, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    schema, kept = "value STRING, day TIMESTAMP", []
    for i in range(6):
        texts = [(f"text {i} {j % 50}", dt.datetime(2024, 1, 1) + dt.timedelta(days=5 * i)) for j in range(100)]
        spark.createDataFrame(texts, schema).coalesce(1).write.mode("append").parquet(inp)
        stream = spark.readStream.schema(schema).parquet(inp)
        once = balances.distinct_within(stream, F.col("day"), "3 days")
        query = (once.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300
    assert max(kept) <= 100  # never more than the days that repeats may still come for


def test_progress_and_a_bounded_wait(spark, tmp_path):
    inp, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    for i in range(3):
        spark.range(10 * (i + 1)).coalesce(1).write.mode("append").parquet(inp)
    stream = lambda: spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).parquet(inp)
    metrics = [F.count(F.lit(1)).alias("n"), F.sum("id").alias("total")]
    none, done = run_observed(stream(), batch_folder_sink(str(tmp_path / "out")), metrics, 0.01, checkpoint)
    assert not done
    seen, done = run_observed(stream(), batch_folder_sink(str(tmp_path / "out")), metrics, 300, checkpoint)
    assert done
    found = {r.batch_id: (r.input_rows, r.n, r.total) for r in none.unionByName(seen.select(*none.columns), allowMissingColumns=True).collect()} if none.count() else {
        r.batch_id: (r.input_rows, r.n, r.total) for r in seen.collect()}
    assert all(str(n) == counted for n, counted, _ in found.values())
    assert spark.read.parquet(str(tmp_path / "out")).count() == 60


def test_rows_through_a_writer(spark, tmp_path):
    make = JsonLines.below(str(tmp_path / "rows"))
    for _ in range(2):  # the task runs again
        writer = RowWriter(make)
        assert writer.open(3, 7)
        for row in spark.createDataFrame([(1, dt.date(2024, 1, 2))], "a int, d date").collect():
            writer.process(row)
        writer.close(None)
    (path,) = glob.glob(str(tmp_path / "rows" / "*" / "*"))
    assert path.endswith("batch_id=7/part-3.json") and json.loads(open(path).read()) == {"a": 1, "d": "2024-01-02"}
