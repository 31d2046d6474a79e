"""The pipeline stage by stage, on its own input and against brute force, and the registered corpus queries."""

import duckdb
from helpers import EXTRA, docs
from test_dedup import brute_groups, brute_print
from test_texts import brute_contamination

import corpus_pipeline
from millrace.llm import quality
from millrace.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.01"


def test_every_stage_on_what_the_one_before_kept(spark):
    docs_now = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns = docs_now.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs_now.collect()}
        after = corpus_pipeline.materialize(stage(spark, docs_now, SMALL), "test-stage")
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept <= set(before) and after.count() == len(kept)
        if name.startswith("quality"):
            model = quality.fit(docs_now, spark.read.parquet(f"{SMALL}/labels.parquet"))
            score = quality.features_with(model[0])
            mean, spread, w = model[1]
            odds = {i: w[0] + sum((f - m) / s * c for f, m, s, c in zip(score(t or ""), mean, spread, w[1:])) for i, t in before.items()}
            wanted = {i for i, z in odds.items() if z >= 0}
        elif name.startswith("exact"):
            last = {}
            for i, t in before.items():
                last[t or ""] = max(last.get(t or "", i), i)
            wanted = set(last.values())
        elif name.startswith("SimHash"):
            ids = sorted(before)
            wanted = set(brute_groups([brute_print(before[i]) for i in ids], ids))
        elif name.startswith("benchmark"):
            wanted = {i for i, t in before.items() if not brute_contamination(t, items)[-1]}
        else:
            assert set(after.columns) == set(columns) - {"text"} | {"ids", "n_ids", "round_trip"}
            assert after.where("NOT round_trip").count() == 0
            break
        assert kept == wanted, name
        assert after.columns == columns
        docs_now = after
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "x y z"), (None, "x y z"), (3, "x y z"), (3, "x y z"), (4, "long " * 20_000)]
    for make in (lambda: docs(spark, rows, EXTRA), lambda: docs(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, make(), SMALL).count()


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    for name, sql in ORACLES.items():
        wanted = con.sql(sql).df()
        columns = sorted(wanted.columns)
        found = QUERIES[name](spark, SMALL).toPandas()
        assert sorted(found.columns) == columns
        lines = lambda df: sorted(map(str, df[columns].itertuples(index=False, name=None)))
        assert lines(found) == lines(wanted), name
