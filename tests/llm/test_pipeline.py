import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlens.llm import components, jaccard, mixing, ngram_lm, quality, queries, tables
from feedlens.llm.tables import materialize

from .conftest import SF001


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF001), name)
        assert docs.columns == columns
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        if name != "source_mix":
            assert docs.count() == len(left)
        ids = left
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_stages_take_edge_rows_and_empty_tables(spark, edge, empty):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge, SF001).columns == edge.columns
        assert stage(spark, empty, SF001).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF001).count() == 0


def test_source_mix_takes_each_document_as_often_as_the_mix(spark, edge):
    """Rows of the stage against the epochs in which the mix takes them, for edge
    rows, repeated rows and clashing columns."""
    stage = dict(corpus_pipeline.STAGES)["source_mix"]
    real = spark.read.parquet(f"{SF001}/documents.parquet")
    clash = edge.withColumns({c: F.lit(7) for c in ("tokens", "domain", "times", "cut", "epoch")})
    for docs in (real, clash, edge.limit(0)):
        rows = queries.mix_documents(docs).withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")})
        chosen = mixing.mix(queries.mix_documents(docs), queries.mix_weights(spark), None, queries.MIX_EPOCHS, queries.MIX_SEED)
        epochs = {}
        for r in chosen.collect():
            epochs.setdefault((r.doc_id, r.lang or "", r.source or "", r.tokens), set()).add(r.epoch)
        want = Counter()
        for r in rows.collect():
            want[r.doc_id] += len(epochs.get((r.doc_id, r.lang, r.source, r.tokens), ()))
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        assert Counter(r.doc_id for r in out.collect()) == +want
    # The text is in no exchange of the stage's plan.
    plan = stage(spark, real, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_a_stage_removes_what_the_one_before_left(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert not any(os.path.exists(p) for p in left)
        left = list(corpus_pipeline._written)
        assert left and all(os.path.exists(p) for p in left)
    # What a frame has yet to read stays.
    again = corpus_pipeline.STAGES[0][1](spark, docs, SF001)
    with tables.recorded() as paths:
        held = tables.materialize(again, "held")
    tables.remove(spark, paths, held)
    assert held.count() == again.count() > 0
    tables.remove(spark, paths)
    assert not os.path.exists(paths[0])


def test_run_leaves_its_result_alone(spark):
    with tables.recorded() as paths:
        out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0
    assert [p for p in paths if os.path.exists(p)] == [p for p in paths if "pipeline-best_fit_packing" in p]


def test_the_driver_holds_small_plans_and_drops_them(spark, monkeypatch):
    """No plan that near_dedup or quality_classifier writes has many exchanges, and
    the driver is cleaned after every few of them (pipeline on a viewfs path took
    more than 1500 MB of the driver's memory)."""
    exchanges, cleaned = [], []

    def counted(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges.append((plan.count("Exchange hashpartitioning"), name))
        return materialize(df, name)

    for module in (components, jaccard, ngram_lm, quality):
        monkeypatch.setattr(module, "materialize", counted)
    monkeypatch.setattr(tables, "clean_driver", lambda spark: cleaned.append(1))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        for name in ("near_dedup", "quality_classifier"):
            dict(corpus_pipeline.STAGES)[name](spark, docs, SF001)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(exchanges)[0] <= 12, sorted(exchanges)[-5:]
    assert len(cleaned) >= len(exchanges) // tables.WRITES_BETWEEN_CLEANING


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.REGISTRY[key](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(cols).collect()), key=repr)
    found = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.SQL[key]})").fetchall()
    assert got == sorted(found, key=repr)
