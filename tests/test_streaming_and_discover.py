import os

from pyspark.sql import functions as F

from feedlens.functions.dates import iso_string
from feedlens.operators.discover import discover_themes
from feedlens.operators.privacy import clean_reviews
from feedlens.sources import tables
from feedlens.streaming import incremental
from feedlens.plans.params import THEME_NAMES, THEME_TERMS

from conftest import SF001


def _dump(spark):
    r = tables.reviews(spark, SF001)
    return r.select("review_id", "source", F.col("rating").cast("string").alias("rating"), "title", "text",
                    iso_string("date").alias("date"))


def test_stream_masks_themes_and_dedupes(spark, tmp_path):
    landing, out, ckpt = (str(tmp_path / x) for x in ("landing", "out", "ckpt"))
    dump = _dump(spark)
    dump.write.json(os.path.join(landing, "batch1"))
    # A second file repeats a slice of the first: the copies must be dropped.
    dump.orderBy("review_id").limit(50).write.json(os.path.join(landing, "batch2"))
    stream = incremental.labelled_stream(incremental.review_stream(spark, landing + "/*"), THEME_TERMS, THEME_NAMES)
    q = incremental.start_labelled_sink(stream, out, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == dump.count()
    assert got.select("review_id").distinct().count() == dump.count()
    assert got.where(F.col("text").rlike(r"[\w.-]+@[\w.-]+\.\w+")).count() == 0
    assert got.where(F.col("theme_id").isNull()).count() == 0
    # Started again on the same checkpoint, nothing is appended.
    stream = incremental.labelled_stream(incremental.review_stream(spark, landing + "/*"), THEME_TERMS, THEME_NAMES)
    incremental.start_labelled_sink(stream, out, ckpt).awaitTermination(300)
    assert spark.read.parquet(out).count() == dump.count()


def test_stream_keeps_reviews_without_ids(spark, tmp_path):
    landing, out, ckpt = (str(tmp_path / x) for x in ("landing", "out", "ckpt"))
    rows = [(None, "reddit", None, None, t, "2026-07-01T10:00:00Z") for t in ("one", "two", "three", "three")]
    rows += [(5, s, None, None, "same id", "2026-07-01T10:00:00Z") for s in ("reddit", "twitter")]
    spark.createDataFrame(rows, "review_id long, source string, rating string, title string, text string, date string") \
        .write.json(landing)
    stream = incremental.labelled_stream(incremental.review_stream(spark, landing), THEME_TERMS, THEME_NAMES)
    incremental.start_labelled_sink(stream, out, ckpt).awaitTermination(300)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["one", "same id", "same id", "three", "two"]


def test_stream_weekly_counts(spark, tmp_path):
    landing = str(tmp_path / "landing")
    _dump(spark).write.json(landing)
    stream = incremental.labelled_stream(incremental.review_stream(spark, landing), THEME_TERMS, THEME_NAMES)
    q = (incremental.weekly_theme_counts(stream).writeStream.format("memory").queryName("weekly_counts")
         .outputMode("complete").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    total = spark.sql("SELECT sum(n_reviews) AS n FROM weekly_counts").first().n
    assert total == 200


def test_discover_themes_properties(spark):
    clean = clean_reviews(tables.reviews(spark, SF001))
    a = discover_themes(clean)
    rows = a.collect()
    assert len(rows) == 200 and len({r.review_id for r in rows}) == 200
    assert 3 <= len({r.theme_id for r in rows}) <= 5
    assert all(r.theme and r.description for r in rows)
    # The themes do not depend on how the rows are partitioned.
    want = {r.review_id: (r.theme_id, r.theme, r.description) for r in rows}
    for parts in (1, 8, 64):
        found = discover_themes(clean.repartition(parts)).collect()
        assert {r.review_id: (r.theme_id, r.theme, r.description) for r in found} == want


def test_clusters_match_brute_force(spark):
    """Sums, silhouettes and the chosen centres against plain numpy on dense vectors."""
    import numpy as np
    from feedlens.operators import discover
    rng = np.random.Generator(np.random.PCG64(3))
    texts = [" ".join(f"{g}{rng.integers(12)}" for _ in range(rng.integers(3, 9))) for g in "xyz" for _ in range(40)] + ["", ""]
    rows = [[hash(w) % discover.FEATURES for w in t.split()] for t in texts]
    df = spark.createDataFrame([(1, [], sorted(r)) for r in rows], "review_id long, _terms array<string>, _cells array<int>").repartition(5)
    idf = np.log((len(rows) + 1) / (discover._document_frequencies(df) + 1.0))
    vectors = discover._with_vectors(df, idf).select("_vector", "_values")
    count = np.zeros((len(rows), discover.FEATURES))
    for j, r in enumerate(rows):
        np.add.at(count[j], r, 1)
    assert (discover._document_frequencies(df) == (count > 0).sum(axis=0)).all()
    dense = count * idf
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    first = discover._first_centres(df, idf, 7, 3)
    model = [first]
    for _ in range(20):
        model = [discover._means(discover._cluster_sums(vectors, model)[0], model[0])]
    centres = model[0] / discover.UNIT
    label = ((dense[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
    sums = discover._cluster_sums(vectors, model)
    for c in range(3):
        assert np.allclose(sums[0][c, :discover.FEATURES] / discover.UNIT, dense[label == c].sum(axis=0), atol=1e-3)
        assert sums[0][c, -1] == (label == c).sum()
    square = ((dense[:, None] - dense[None]) ** 2).sum(axis=2)
    each = []
    for j in range(len(rows)):
        mean = [square[j, label == c].sum() / max((label == c).sum() - (label[j] == c), 1) for c in range(3)]
        a, b = mean[label[j]], min(m for c, m in enumerate(mean) if c != label[j])
        each.append((b - a) / max(a, b) if (label == label[j]).sum() > 1 else 0)
    assert abs(discover._silhouettes(vectors, model, sums)[0] - discover.UNIT * np.mean(each)) < 1e-3 * discover.UNIT
    # The three vocabularies part the rows.
    assert sorted(np.unique(label[j:j + 40]).size for j in (0, 40, 80)) == [1, 1, 1]


def test_discover_themes_edges(spark):
    schema = "review_id long, text string"
    assert discover_themes(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None), (2, ""), (None, "same words here"), (4, "same words here")]
    assert discover_themes(spark.createDataFrame(rows, schema)).count() == 4
    assert {r.theme_id for r in discover_themes(spark.createDataFrame(rows[2:], schema)).collect()} == {"theme_1"}
    assert discover_themes(spark.createDataFrame(rows[:2], schema)).count() == 2


def test_discover_themes_checkpoints_no_terms(spark, monkeypatch):
    """what is written is read by column, and Python tasks get no terms."""
    from feedlens.operators import discover

    def refused(*args, **kwargs):
        raise AssertionError("checkpoint")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refused)
    rows = [(1, "cold food"), (2, "late food"), (None, "high price"), (3, None), (3, "price price")]
    assert discover_themes(spark.createDataFrame(rows, "review_id long, text string")).count() == len(rows)
    df = spark.createDataFrame([(1, ["a"], [3]), (2, [], [])], "review_id long, _terms array<string>, _cells array<int>")
    plan = discover._with_vectors(df, discover.np.ones(discover.FEATURES))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
