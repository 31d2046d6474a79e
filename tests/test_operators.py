import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions import records, text, types, udfs
from millrace.functions.dates import in_period, period_bounds, resolve_business_date
from millrace.operators import aggregates, cells, joins, sampling, sessions, statistics as st
from millrace.session import cut_lineage, size_settings, work_root
from millrace.sinks import writers
from millrace.sources import files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- types, text, records --------------------------------------------------------------------


def test_type_names():
    assert types.type_by_name("BigDecimal") == T.DecimalType(24, 6)
    assert types.type_by_name("byte[]") == T.BinaryType()
    with pytest.raises(ValueError):
        types.type_by_name("blob")
    assert types.schema_from_names("name age").simpleString() == "struct<name:string,age:string>"


def test_record_layouts():
    assert [len(s) for s in (records.TRADE, records.LEDGER, records.LEDGER_JSON, records.STOCK_SNAPSHOT,
                             records.FUND_SNAPSHOT)] == [50, 82, 83, 39, 33]
    kinds = lambda s: [sum(f.dataType.typeName() == k for f in s) for k in ("string", "long", "integer", "decimal")]
    assert kinds(records.TRADE) == [33, 11, 0, 6]
    assert kinds(records.LEDGER) == [39, 26, 0, 17]
    assert kinds(records.LEDGER_JSON) == [57, 11, 15, 0]
    assert kinds(records.STOCK_SNAPSHOT) == [7, 26, 0, 6]
    assert kinds(records.FUND_SNAPSHOT) == [4, 4, 0, 25]
    assert len(records.LEDGER_JSON_DECIMALS) == 18


def test_delimited_people(spark):
    lines = spark.createDataFrame([("Edith, 51",), ("Olaf, 44",), ("Mina, 16",), ("broken",), (None,)], "value STRING")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])
    got = records.parse_delimited(lines, schema, trim=True)
    assert rows(got.where("age BETWEEN 13 AND 19")) == [("Mina", 16)]
    assert got.count() == 5
    assert got.where("name = 'broken'").first().age is None


def test_format_and_parse_are_inverse(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "fundid BIGINT, bsflag STRING")
    line = records.format_delimited({"fundid": F.col("fundid"), "bsflag": F.col("bsflag")}, records.TRADE)
    got = records.parse_delimited(df.select(line.alias("value")), records.TRADE)
    assert rows(got.select("fundid", "bsflag", "trddate", "remark")) == [(1, "a", None, ""), (2, "", None, "")]


def test_json_records(spark):
    df = spark.createDataFrame([('{"name":"Edith"}',), ('{"name":"Olaf","age":44}',), ("{bad",),
                                ('{"name":"X","age":"old"}',), (None,)], "value STRING")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.LongType())])
    assert rows(records.parse_json(df, schema)) == sorted(
        [("Edith", None), ("Olaf", 44), (None, None), ("X", None), (None, None)], key=str)


def test_joined_key_and_lookup(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k STRING, n INT")
    got = df.select(text.joined_key(F.col("k"), F.col("n")).alias("key"), text.lookup({"a": "x"}, F.col("k")).alias("v"))
    assert rows(got) == [("a_1", "x"), (None, None)]


def test_padded_key_never_truncates(spark):
    got = spark.createDataFrame([(5,), (1234567890,)], "n BIGINT").select(text.padded_key(F.col("n")))
    assert rows(got) == [("00000005",), ("1234567890",)]


def test_plain_decimal_text(spark):
    df = spark.sql("SELECT 'k' AS k, CAST(0.0000001 AS DECIMAL(24,10)) AS d, CAST('xyz' AS BINARY) AS b, CAST(NULL AS INT) AS n, 7L AS l")
    assert rows(cells.rows_to_cells(df, ["k"], ["d", "b", "n", "l"]).select("qualifier", "value")) == [
        ("b", "xyz"), ("d", "0.0000001000"), ("l", "7")]


def test_business_date():
    today = dt.date(2020, 3, 1)
    assert resolve_business_date("-1", "20200101") == "-1"
    assert resolve_business_date(None, "20200114093000") == "20200114"
    assert resolve_business_date(None, None, today) == "20200229"
    assert resolve_business_date(None, None, today, "%Y-%m-%d") == "2020-02-29"
    assert period_bounds("202312")[1] == dt.datetime(2024, 1, 1)
    assert period_bounds("20231231")[1] == dt.datetime(2024, 1, 1)


def test_period_filter_reaches_the_scan(spark, small):
    plan = files.table(spark, small, "orders").where(in_period(F.col("o_orderdate"), "199603"))
    assert "GreaterThanOrEqual(o_orderdate" in plan._jdf.queryExecution().toString()


# --- sources and sinks -----------------------------------------------------------------------


def test_people_json(spark, tmp_path):
    path = tmp_path / "people.json"
    path.write_text('{"name":"Edith"}\n{"name":"Olaf","age":44}\n{"name":"Mina","age":16}\n')
    people = files.read_json(spark, str(path))
    assert rows(people.where("age > 21").select("name")) == [("Olaf",)]
    assert rows(people.groupBy("age").count()) == [(16, 1), (44, 1), (None, 1)]


def test_people_csv(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("name;age;job\nIlse;27;Baker\nTom;58;Baker\n")
    people = files.read_csv(spark, str(path), sep=";")
    assert people.dtypes == [("name", "string"), ("age", "int"), ("job", "string")]
    assert people.agg(F.sum("age")).first()[0] == 85


def test_merged_schema(spark, tmp_path):
    root = str(tmp_path / "merged")
    numbers = spark.range(1, 11).select(F.col("id").cast("int").alias("value"))
    numbers.where("value <= 5").withColumn("square", F.col("value") * F.col("value")).write.parquet(f"{root}/key=1")
    numbers.where("value > 5").withColumn("cube", F.pow("value", F.lit(3)).cast("int")).write.parquet(f"{root}/key=2")
    merged = files.read_merged(spark, root)
    assert sorted(merged.columns) == ["cube", "key", "square", "value"]
    assert merged.count() == 10 and merged.where("square IS NULL").count() == 5


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    writers.write_files(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_files(df, path)
    writers.write_files(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 3
    writers.write_files(df, path, mode="append")
    assert spark.read.parquet(path).count() == 6
    writers.write_files(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_partitioned_write_replaces_only_written_keys(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v INT, k STRING")
    writers.write_partitioned(df, path, ["k"])
    writers.write_partitioned(spark.createDataFrame([(9, "a")], "v INT, k STRING"), path, ["k"])
    back = spark.read.parquet(path)
    assert back.columns == ["v", "k"] and rows(back) == [(2, "b"), (9, "a")]


def test_input_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(10).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    assert len(df.inputFiles()) == 3
    assert files.with_input_file(df).select("input_file").distinct().count() == 3


def test_column_types_from_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS t_types (a BIGINT, b STRING) USING parquet LOCATION '{tmp_path}/t_types'")
    assert files.catalog_column_types(spark, "t_types") == {"a": "bigint", "b": "string"}
    assert files.column_types(spark.table("t_types")) == {"a": "bigint", "b": "string"}


def test_table_ddl(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS t_ddl (k INT) USING parquet LOCATION '{tmp_path}/t_ddl'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS t_ddl (k INT) USING parquet LOCATION '{tmp_path}/t_ddl'")
    assert spark.catalog.tableExists("t_ddl")
    spark.sql("DROP TABLE IF EXISTS t_ddl")
    spark.sql("DROP TABLE IF EXISTS t_ddl")
    assert not spark.catalog.tableExists("t_ddl")


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "k")
    for n in ("b1", "b2"):
        writers.write_bucketed(df, n, str(tmp_path / n), 4, ["k"])
    joined = spark.table("b1").join(spark.table("b2").hint("merge"), "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 100


def test_messages_leave_out_nulls(spark):
    df = spark.createDataFrame([("k1", 1, None), ("k2", 2, "x")], "k STRING, a INT, b STRING")
    assert rows(writers.to_messages(df, "t", "k")) == [("t", "k1", '{"a":1}'), ("t", "k2", '{"a":2,"b":"x"}')]


# --- cells -----------------------------------------------------------------------------------


def test_rows_cells_rows(spark):
    df = spark.createDataFrame([("rk001", "leo", 13), ("rk002", None, 12), (None, "x", 1)], "rk STRING, name STRING, age INT")
    kept, rejected = cells.split_keyless(df, ["rk"])
    assert rejected.count() == 1
    out = cells.rows_to_cells(df, ["rk"])
    assert out.count() == 5 and out.columns == cells.CELL_COLUMNS
    assert rows(cells.cells_to_wide(out, {"name": "string", "age": "int"})) == rows(kept.toDF("rowkey", "name", "age"))


def test_export_is_globally_sorted(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(2000).select(text.padded_key(F.col("id") * 7919 % 2000).alias("rk"), F.lit("v").alias("a"), F.lit("w").alias("b"))
    cells.export_sorted(cells.rows_to_cells(df, ["rk"], ["a", "b"]), path, 4)
    per_file = []
    for name in sorted({r[0] for r in files.with_input_file(spark.read.parquet(path)).select("input_file").collect()}):
        keys = [(r.rowkey, r.qualifier) for r in spark.read.parquet(name).collect()]
        assert keys == sorted(keys)
        per_file.append((keys[0], keys[-1]))
    assert len(per_file) == 4
    assert all(a[1] < b[0] for a, b in zip(sorted(per_file), sorted(per_file)[1:]))


def test_upsert_keeps_older_cells(spark):
    schema = "rowkey STRING, family STRING, qualifier STRING, value STRING, v INT"
    old = spark.createDataFrame([("r", "cf", "a", "1", 1), ("r", "cf", "b", "1", 1)], schema)
    new = spark.createDataFrame([("r", "cf", "a", "2", 2)], schema)
    assert rows(cells.keyed_upsert(old, new, ["v"]).select("qualifier", "value")) == [("a", "2"), ("b", "1")]


def test_day_slice(spark):
    df = spark.createDataFrame([("20200101", 1), ("20200102", 2)], "d STRING, x INT")
    assert rows(cells.slice_by_day(df, "d", "20200102")) == [("20200102", 2)]
    assert cells.slice_by_day(df, "d", "-1").count() == 2
    assert cells.slice_by_day(df, None, "20200102").count() == 2


# --- joins and aggregates --------------------------------------------------------------------


def test_lookup_is_broadcast_and_holds_its_bound(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    big, few = spark.range(1000), spark.range(10)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    before = jobs()
    joined = big.join(joins.lookup(few, 10), "id")
    assert "broadcast" in plan(joined) and jobs() == before  # nothing ran while the plan was built
    assert joined.count() == 10
    with pytest.raises(Exception, match="more than the declared 9 rows"):
        big.join(joins.lookup(few, 9), "id").count()
    assert big.join(joins.lookup(few.where("id < 0")), "id").count() == 0


def test_pairs_of_an_unbounded_side_fail(spark):
    pairs = lambda n: joins.join_pairs(spark.range(3), spark.range(n), F.col("l.id") < F.col("r.id"), max_right=5)
    assert pairs(5).count() == 4 + 3 + 2
    with pytest.raises(Exception, match="more than the declared 5 rows"):
        pairs(6).count()


def test_char_padding(spark, tmp_path):
    spark.sql(f"CREATE TABLE IF NOT EXISTS t_char (code CHAR(8), a INT) USING parquet LOCATION '{tmp_path}/c'")
    spark.sql("INSERT INTO t_char VALUES ('000709', 1)")
    plain = spark.createDataFrame([("000709", 2)], "code STRING, b INT")
    assert spark.table("t_char").join(plain, "code").count() == 0
    assert rows(joins.join_trimmed(spark.table("t_char"), plain, ["code"])) == [("000709", 1, 2)]


def test_pairs_of_a_theta_join(spark):
    left = spark.createDataFrame([(1,), (2,)], "id INT")
    right = spark.createDataFrame([(7,), (8,)], "x INT")
    got = joins.join_pairs(left, right, F.col("l.id") > 1)
    assert got.where("r IS NULL").select("l.id").collect()[0][0] == 1
    assert got.count() == 3


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_matches_brute_force(spark, how):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    make = lambda n: [(i, rnd.choice("ab"), base + dt.timedelta(seconds=rnd.randrange(0, 300))) for i in range(n)]
    ls, rs = make(60), make(60)
    left = spark.createDataFrame(ls, "i INT, k STRING, t1 TIMESTAMP")
    right = spark.createDataFrame(rs, "j INT, k2 STRING, t2 TIMESTAMP")
    got = rows(joins.interval_join(left, right, ("k", "k2"), ("t1", "t2"), 20, how).select("i", "j"))
    want = []
    for i, k, t1 in ls:
        hits = [(i, j) for j, k2, t2 in rs if k == k2 and t2 <= t1 < t2 + dt.timedelta(seconds=20)]
        want += hits or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k BIGINT, v STRING")
    assert rows(joins.salted_join(left, right, ["k"], 4, how)) == rows(left.join(right, "k", how))
    with pytest.raises(ValueError):
        joins.salted_join(left, right, ["k"], 4, "right")


def test_difference_semi_join_matches_exists(spark):
    rnd = random.Random(3)
    make = lambda: [(rnd.randrange(8), rnd.choice("pqr")) for _ in range(25)]
    ls, rs = make(), make()
    left, right = (spark.createDataFrame(x, "k INT, p STRING") for x in (ls, rs))
    got = rows(joins.semi_with_difference(left, right, "k", "p"))
    assert got == sorted(((k, p) for k, p in ls if any(k == k2 and p != p2 for k2, p2 in rs)), key=str)


def test_multiset_operations(spark):
    a = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "i INT, s STRING")
    b = spark.createDataFrame([(1, None), (1, None), (3, "z")], "i INT, s STRING")
    assert rows(aggregates.intersect_multiset(a, b)) == rows(a.intersectAll(b))
    assert rows(aggregates.except_multiset(a, b)) == rows(a.exceptAll(b))


def test_set_operations_with_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (4, None)], "i INT, s STRING")
    b = spark.createDataFrame([(1, None), (3, "z"), (2, "x"), (2, "x")], "i INT, s STRING")
    assert rows(aggregates.intersect_rows(a, b)) == rows(a.intersect(b))
    assert rows(aggregates.except_rows(a, b)) == rows(a.subtract(b))


def test_semi_and_anti_join(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    b = spark.createDataFrame([(1,)] * 5 + [(None,)], "k INT")
    assert rows(joins.keep_matching(a, b, ["k"])) == rows(a.join(b, "k", "left_semi")) == [(1, "a")]
    assert rows(joins.drop_matching(a, b, ["k"])) == rows(a.join(b, "k", "left_anti"))


def test_copies_beyond_one_chunk(spark):
    df = spark.createDataFrame([("hot", 25), ("cold", 1), ("none", 0)], "k STRING, n BIGINT")
    got = aggregates.repeat_rows(df, "n", chunk=4, name="no")
    assert rows(got) == sorted([("hot", i) for i in range(1, 26)] + [("cold", 1)], key=str)


def test_first_by(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("b", 3, "w")], "k STRING, t INT, v STRING")
    assert rows(aggregates.first_by(df, ["k"], ["t"])) == [("a", 1, "z"), ("b", 3, "w")]


def test_average_of_employees(spark):
    pay = spark.createDataFrame([(3000,), (4500,), (3500,), (4000,), (None,)], "salary BIGINT")
    udfs.register_functions(spark)
    pay.createOrReplaceTempView("employees")
    assert spark.sql("SELECT my_average(sum(salary), count(salary)) AS a FROM employees").first().a == 3750.0
    assert spark.sql("SELECT my_average(sum(salary), count(salary)) AS a FROM employees WHERE salary < 0").first().a is None


def test_hello_of_null(spark):
    udfs.register_functions(spark)
    df = spark.createDataFrame([("bob",), (None,)], "s STRING")
    got = df.select(F.call_udf("hello", "s").alias("a"), udfs.hello(F.col("s")).alias("b"))
    assert rows(got) == [("hello bob", "hello bob"), ("hello null", "hello null")]


# --- statistics ------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [
    [float(i) for i in range(1001)], [1.0] * 700 + [float(i) for i in range(300)],
    [random.Random(1).gauss(0, 1e6) for _ in range(5000)], [3.0], [1.0, 2.0]])
def test_exact_quantiles_by_narrowing(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    probs = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)
    got = st.exact_quantiles(df, "x", probs, leaf=20)  # a small leaf forces the narrowing passes
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


@pytest.mark.parametrize("leaf", [1, 100_000])
def test_quantiles_of_infinities_and_ties(spark, leaf):
    inf = float("inf")
    df = lambda *v: spark.createDataFrame([(x,) for x in v], "x DOUBLE")
    assert st.exact_quantiles(df(inf, inf, inf, 1.0, None), "x", (0.5, 0.9, 0.0), leaf) == {0.5: inf, 0.9: inf, 0.0: 1.0}
    assert st.exact_quantiles(df(-inf, -inf, 2.0, 2.0, 2.0), "x", (0.25, 0.75), leaf) == {0.25: -inf, 0.75: 2.0}
    assert st.exact_quantiles(df(None), "x", (0.5,), leaf) == {}


def test_frequent_items_count_nulls(spark):
    df = spark.createDataFrame([(None, "x")] * 6 + [("a", None)] * 4, "p STRING, q STRING")
    assert rows(st.frequent_items(df, "p", 0.3)) == [("a", 4), (None, 6)] or rows(st.frequent_items(df, "p", 0.3)) == [(None, 6), ("a", 4)]
    got = {tuple(r) for r in st.frequent_items_of(df, ["p", "q"], 0.5).collect()}
    assert got == {("p", None, 6), ("q", "x", 6)}


def test_crosstab_finds_its_values(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "Z"), ("s", None)], "k STRING, v STRING")
    got = {r.k: r.asDict() for r in st.crosstab(df, "k", "v").collect()}
    assert got == {"r": {"k": "r", "a": 1, "Z": 1, "null": 0}, "s": {"k": "s", "a": 0, "Z": 0, "null": 1}}


def test_bloom_filter_loses_nothing(spark):
    members = spark.range(0, 20000, 7).withColumnRenamed("id", "x")
    n = members.count()
    bloom = st.bloom_build(members, "x", n)
    assert st.bloom_filter(members, "x", bloom, n).count() == n
    others = spark.range(1_000_000, 1_020_000).withColumnRenamed("id", "x")
    assert st.bloom_filter(others, "x", bloom, n).count() < 20000 * 0.05


def test_frequent_items_are_exact(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [(str(i),) for i in range(20)], "x STRING")
    assert rows(st.frequent_items(df, "x", 0.3)) == [("a", 50), ("b", 30)]


def test_keyed_split_is_a_partition(spark):
    df = spark.range(5000)
    parts = sampling.keyed_split(df, "id", [1, 2, 1])
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and all(s > 800 for s in sizes)
    assert parts[0].intersect(parts[1]).count() == 0


def test_layout(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 5)
    assert sampling.layout(df, 3, "k").rdd.getNumPartitions() == 3
    assert sampling.layout(df, 3, F.desc("k"), ranged=True).rdd.getNumPartitions() == 3
    assert sampling.layout(df.repartition(4), 1).rdd.getNumPartitions() == 1
    parts = sampling.layout(df, 3, "k").withColumn("p", F.spark_partition_id())
    assert parts.groupBy("k").agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0] == 1


def test_foreach_partition(spark):
    seen = spark.sparkContext.accumulator(0)

    def visit(part):
        for _ in part:
            seen.add(1)

    spark.range(37).repartition(4).foreachPartition(visit)
    assert seen.value == 37


def test_persist_and_checkpoint_keep_rows(spark):
    from pyspark import StorageLevel

    df = spark.range(100).withColumn("x", F.col("id") * 2)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    assert rows(kept) == rows(df)
    kept.unpersist()
    cut = cut_lineage(df)
    assert rows(cut) == rows(df)
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert rows(cut_lineage(df, eager=False)) == rows(df)


def test_work_folder_is_the_configured_one(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partition_settings_grow_with_the_data():
    small_job, large_job = size_settings(1 << 20, 8), size_settings(100 << 40, 8000)
    assert small_job["spark.sql.shuffle.partitions"] == "16"
    assert large_job["spark.sql.shuffle.partitions"] == "200000"
    assert size_settings(1 << 40, 100)["spark.sql.shuffle.partitions"] == "4096"


def test_transform_chain(spark):
    out = (spark.createDataFrame([("A", 1), (None, 2)], "rk STRING, x INT")
           .transform(lambda df: df.where("x < 3")).transform(cells.rows_to_cells, ["rk"], ["x"]))
    assert rows(out) == [("A", "cf", "x", "1")]


# --- sessions --------------------------------------------------------------------------------


def _events(spark, minutes, given=None):
    base = dt.datetime(2024, 1, 1, 0, 0, 30)
    data = [(i, "u", base + dt.timedelta(minutes=m), (given or {}).get(i)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, "id INT, user STRING, ts TIMESTAMP, g STRING")


def test_gap_equal_to_the_limit_stays(spark):
    got = sessions.sessionize(_events(spark, [0, 30, 90, 151]), "user", "ts", "id").orderBy("id")
    assert [r.session_no for r in got.collect()] == [1, 1, 1, 2]


@pytest.mark.parametrize("bucket", [60, 900])
def test_given_id_is_kept_and_carried(spark, bucket):
    df = _events(spark, [0, 10, 20, 70, 80, 200], {1: "S9"})
    got = sessions.sessionize(df, "user", "ts", "id", given=F.col("g"), bucket_seconds=bucket).orderBy("id")
    assert [r.session_id for r in got.collect()] == ["u_1", "S9", "S9", "S9", "S9", "u_3"]


@pytest.mark.parametrize("bucket", [60, 3600, 10 ** 6, 10 ** 7])
def test_sessions_do_not_depend_on_buckets(spark, bucket):
    rnd = random.Random(8)
    minutes = sorted(rnd.randrange(0, 6000) for _ in range(150))
    given = {i: f"g{i}" for i in range(0, 150, 17)}
    got = sessions.sessionize(_events(spark, minutes, given), "user", "ts", "id", given=F.col("g"), bucket_seconds=bucket)
    want, no, last, current = [], 0, None, None
    for i, m in enumerate(minutes):
        if i in given:
            no, current = no + 1, given[i]
        elif last is None or m - last > 60:
            no, current = no + 1, f"u_{no + 1}"
        last = m
        want.append((i, no, current))
    assert sorted(tuple(r) for r in got.select("id", "session_no", "session_id").collect()) == want


@pytest.mark.parametrize("gap", [60, 3600, 90_000])
def test_plain_sessions_match_a_loop(spark, gap):
    rnd = random.Random(4)
    minutes = sorted(rnd.randrange(0, 9000) for _ in range(200))
    got = sessions.sessionize(_events(spark, minutes), "user", "ts", "id", gap_seconds=gap)
    want, no, last = [], 0, None
    for i, m in enumerate(minutes):
        if last is None or (m - last) * 60 > gap:
            no += 1
        last = m
        want.append((i, no, f"u_{no}"))
    assert sorted(tuple(r) for r in got.select("id", "session_no", "session_id").collect()) == want


def test_sessions_keep_rows_without_a_user_or_a_time(spark):
    """Rows without a time come first and are one session; both ways of finding sessions agree on it."""
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([(1, None, at(0), None), (2, "u", at(0), None), (3, "u", None, None), (4, "u", None, None),
                                (5, "u", at(30), None), (6, None, None, None)], "id INT, user STRING, ts TIMESTAMP, g STRING")
    want = [(1, 2), (2, 2), (3, 1), (4, 1), (5, 2), (6, 1)]
    for given in (None, F.col("g")):
        got = sessions.sessionize(df, "user", "ts", "id", given=given)
        assert sorted(tuple(r) for r in got.select("id", "session_no").collect()) == want


def test_a_bucket_with_very_many_events(spark):
    """A hot user whose events fall into few buckets gets the sessions of the others."""
    base = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, 100).otherwise(F.col("id") % 50).alias("user"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id") % 40).otherwise(F.pmod(F.xxhash64("id"), F.lit(86400 * 20)))).alias("ts"))
    plain = rows(sessions.sessionize(base, "user", "ts", "id"))
    assert plain == rows(sessions.sessionize(base, "user", "ts", "id", given=F.lit(None), bucket_seconds=30))
    assert {r[-1] for r in plain if r[1] == 100} == {"100_1"}
