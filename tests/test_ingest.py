import datetime as dt

import pytest

from pyspark.sql import functions as F

from feedlens.functions.dates import parse_date
from feedlens.operators import ingest
from feedlens.sources import readers

from conftest import GOLDEN_AS_OF, SF01


def test_parse_dates_fixture(spark):
    # FIXTURES F-5 dates: empty, 'bad' and NULL give NULL.
    rows = [("2026-06-25T14:30:00Z",), ("2026-06-25T14:30:00-07:00",), ("2026-06-25T14:30:00",),
            ("2026-06-25",), ("2026-06-25T14:30:00.123456+05:30",), ("",), ("bad",), (None,)]
    got = [r.d for r in spark.createDataFrame(rows, "s string").select(parse_date("s").alias("d")).collect()]
    assert got == [dt.datetime(2026, 6, 25, 14, 30), dt.datetime(2026, 6, 25, 21, 30),
                   dt.datetime(2026, 6, 25, 14, 30), dt.datetime(2026, 6, 25),
                   dt.datetime(2026, 6, 25, 9, 0, 0, 123456), None, None, None]


def test_window_is_inclusive_and_pushed_down(spark, golden):
    kept = ingest.rolling_window(golden, GOLDEN_AS_OF, weeks=1)
    assert sorted(r.review_id for r in kept.collect()) == [8, 9, 10, 11, 12, 13, 14]
    edge = ingest.rolling_window(golden, "2026-07-08T10:00:00Z", weeks=2)  # start = 06-24 10:00
    assert 4 in [r.review_id for r in edge.collect()]


def test_window_filter_reaches_parquet_scan(spark):
    from feedlens.sources import tables
    r = tables.reviews(spark, "/root/testdata/sf0.001")
    plan = ingest.rolling_window(r, "2024-01-20T00:00:00", 1)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_source_precedence(spark, golden):
    primary = golden.where(F.col("source") == "appstore")
    out = ingest.source_precedence(primary, golden)
    srcs = {r.source for r in out.collect()}
    assert "appstore" not in srcs and "playstore" in srcs and "reddit" in srcs
    empty = golden.where(F.lit(False))
    assert ingest.source_precedence(empty, golden).count() == 14


def test_union_counts(golden):
    play = golden.where(F.col("source") == "playstore")
    app = golden.where(F.col("source") == "appstore")
    social = golden.where(~F.col("source").isin("playstore", "appstore"))
    u = ingest.union_sources(play, app, social)
    assert u.count() == 14
    assert {(r.source, r.priority) for r in u.select("source", "priority").distinct().collect()} >= {
        ("playstore", 1), ("appstore", 2), ("reddit", 3)}


def _feed(spark, rows):
    return spark.createDataFrame(
        [(i, p, 5, "t", "x", d) for i, p, d in rows],
        "review_id long, page long, rating int, title string, text string, date timestamp_ntz")


def test_take_while_stops_at_first_page_without_window_rows(spark):
    new, old = dt.datetime(2026, 7, 6), dt.datetime(2026, 1, 1)
    rows = [(1, 1, new), (2, 1, old), (3, 2, new), (4, 3, old), (5, 4, new), (6, 5, new)]
    out = ingest.feed_take_while(_feed(spark, rows), GOLDEN_AS_OF, weeks=1)
    assert sorted(r.review_id for r in out.collect()) == [1, 3]


def test_take_while_gap_and_empty(spark):
    new = dt.datetime(2026, 7, 6)
    rows = [(1, 1, new), (2, 2, new), (3, 4, new)]  # page 3 missing: stop there
    out = ingest.feed_take_while(_feed(spark, rows), GOLDEN_AS_OF, weeks=1)
    assert sorted(r.review_id for r in out.collect()) == [1, 2]
    rows = [(1, 2, new)]  # page 1 missing: nothing is read
    assert ingest.feed_take_while(_feed(spark, rows), GOLDEN_AS_OF, weeks=1).count() == 0


def test_take_while_has_no_page_limit(spark):
    new = dt.datetime(2026, 7, 6)
    rows = [(i, i, new) for i in range(1, 40)]
    assert ingest.feed_take_while(_feed(spark, rows), GOLDEN_AS_OF, weeks=1).count() == 39


def test_complete_crawl_keeps_every_window_row(spark):
    from feedlens.plans import catalog
    r = catalog._reviews(spark, SF01)
    window = ingest.rolling_window(r, catalog._asof(r), catalog.WEEKS)
    union = catalog.q_union_sources(spark, SF01)
    assert union.count() == window.count() == union.select("review_id").distinct().count()
    plan = union._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2 * 2 and "NestedLoop" not in plan


def test_take_while_per_app(spark):
    new, old = dt.datetime(2026, 7, 6), dt.datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [("a", 1, 1, new), ("a", 2, 2, old), ("a", 3, 3, new), ("b", 4, 1, new), ("b", 5, 2, new)],
        "app string, review_id long, page long, date timestamp_ntz")
    out = ingest.feed_take_while(df, GOLDEN_AS_OF, weeks=1, by=("app",))
    assert sorted(r.review_id for r in out.collect()) == [1, 4, 5]


def test_newest_n_then_window(golden):
    out = ingest.newest_n(golden, 3)
    assert [r.review_id for r in out.collect()] == [14, 13, 12]


def test_resample_by_rate(spark):
    df = spark.range(4000).withColumnRenamed("id", "review_id")
    out = ingest.resample(df, 0.25, seed=7)
    assert out.where("draw = 0").count() == 4000
    assert 850 < out.where("draw = 1").count() < 1150
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ingest.resample(df.repartition(3), 0.25, seed=7).collect()))
    assert ingest.resample(df.where("review_id < 0"), 0.25, seed=7).count() == 0


def test_source_window_counts(spark, golden):
    bad = golden.union(spark.createDataFrame([(99, "reddit", None, None, "x", None)], golden.schema))
    counts = {r.source: r for r in ingest.source_window_counts(bad, GOLDEN_AS_OF, 1).collect()}
    assert counts["reddit"].seen == 5 and counts["reddit"].rejected == 1 and counts["reddit"].kept == 2
    assert counts["twitter"].kept == 3


def test_split_on_dates(spark):
    df = spark.createDataFrame([(1, "2026-07-01T00:00:00Z"), (2, "July 01, 2026"), (3, None)],
                               "review_id long, date_raw string")
    kept, rejected = ingest.split_on_dates(df)
    assert [r.review_id for r in kept.collect()] == [1]
    assert sorted(r.review_id for r in rejected.collect()) == [2, 3]


def test_json_array_dump(spark, tmp_path):
    p = tmp_path / "dump.json"
    p.write_text('[{"source": "reddit", "rating": null, "title": "t", "text": "x", '
                 '"date": "2026-07-01T10:00:00Z"},\n {"source": "twitter", "rating": "4", "text": "y", '
                 '"date": "bad"},\n {"source": "appstore", "rating": "9", "text": "z", '
                 '"date": "2026-07-02"}]')
    rows = readers.scan_reviews_json(spark, str(p), multi_line=True).orderBy("source").collect()
    assert [r.source for r in rows] == ["appstore", "reddit"]
    assert rows[0].rating is None  # 9 is outside 1..5
    assert readers.scan_reviews_json_rejects(spark, str(p), multi_line=True).count() == 1


def test_missing_or_malformed_dump_gives_no_rows(spark, tmp_path):
    assert readers.scan_reviews_json(spark, str(tmp_path / "absent.json"), multi_line=False).count() == 0
    assert readers.scan_reviews_json(spark, str(tmp_path / "absent-*.json"), multi_line=True).count() == 0
    bad = tmp_path / "bad.json"
    bad.write_text("this is not json\n{\"source\": \"reddit\", \"text\": \"x\", \"date\": \"2026-07-01\"}\n")
    rows = readers.scan_reviews_json(spark, str(bad), multi_line=False).collect()
    assert [r.source for r in rows] == ["reddit"]


def test_numbering_keeps_null_and_repeated_ids(spark):
    from feedlens.operators.ordering import number_within
    day = dt.datetime(2026, 7, 1)
    rows = [(None, "a", day), (None, "a", day), (5, "a", day), (5, "b", day), (5, "b", day)]
    df = spark.createDataFrame(rows, "review_id long, source string, date timestamp_ntz")
    out = number_within(df, ["source"], ["date", "review_id"])
    assert sorted((r.source, r.rn) for r in out.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2)]


def test_ratings_dates_and_rejects(spark, tmp_path):
    raw = spark.createDataFrame([("4.0",), ("4.5",), ("4",), ("6",), ("0",), ("x",), (None,)], "r string")
    assert [r[0] for r in raw.select(readers.coerce_rating("r")).collect()] == [4, 5, 4, None, None, None, None]
    from feedlens.functions.dates import parse_date
    bad = ["10:30", "T10:30", "2024", "2024-05", "2024-1-5", "2024-01-05 10:00:00 Europe/Berlin", "", None]
    good = ["2024-01-05", "2024-01-05T10:00", "2024-01-05 10:00:00.5", "2024-01-05T10:00:00Z", "2024-01-05T10:00:00+02:00"]
    df = spark.createDataFrame([(x,) for x in bad + good], "d string")
    got = [r[0] is None for r in df.select(parse_date("d")).collect()]
    assert got == [True] * len(bad) + [False] * len(good)
    p = tmp_path / "lines.json"
    p.write_text('{"source": "reddit", "text": "a", "date": "2024-01-05"}\nnot json\n'
                 '{"source": "reddit", "text": "b", "date": "soon"}\n')
    assert readers.scan_reviews_json(spark, str(p), multi_line=False).count() == 1
    rejects = {r.reason: r.record for r in readers.scan_reviews_json_rejects(spark, str(p), multi_line=False).collect()}
    assert rejects["not JSON"] == "not json" and '"b"' in rejects["no ISO date"]
    array = tmp_path / "array.json"
    array.write_text('[\n  {"source": "reddit", "text": "a", "date": "2024-01-05"},\n'
                     '  {"source": "reddit", "text": "b", "date": "2024-01-06"}\n]\n')
    assert readers.scan_reviews_json(spark, str(array), multi_line=True).count() == 2


def test_theme_join_form_equals_the_inline_form(spark):
    from feedlens.functions.lexicon import lexicon_frame
    from feedlens.plans.params import THEME_NAMES, THEME_TERMS
    from feedlens.operators import themes
    from feedlens.operators.privacy import clean_reviews
    from feedlens.sources import tables
    clean = clean_reviews(tables.reviews(spark, SF01))
    inline = themes.assign_themes(clean, THEME_TERMS, THEME_NAMES).select("review_id", "theme_id", "theme_score")
    joined = themes.assign_themes_by_join(clean, lexicon_frame(spark, THEME_TERMS)).select(
        "review_id", "theme_id", "theme_score")
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, joined.collect()))


def test_shared_folder_is_required_on_a_cluster():
    from feedlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.checkpoint_root(Session())
