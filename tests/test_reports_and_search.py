import pytest
from pyspark.sql import functions as F

from feedlens.operators import metrics, reports, search, themes
from feedlens.operators.ordering import number_within, top_k_within
from feedlens.operators.privacy import clean_reviews
from feedlens.plans.params import QUESTION_TERMS, THEME_NAMES, THEME_TERMS

NOTE = """# Pulse
## Strategic Action Ideas
1. **Fix the cart**
2. Add live chat. Soon
- Improve dispatch
- Re-check sign-up flow
1. **Fix the cart**
---

## Other
- not an item
"""


def test_parse_action_items(spark):
    notes = spark.createDataFrame([("a", NOTE), ("b", "# Nothing here\n- x\n")], "report_key string, note string")
    out = reports.parse_action_items(notes).orderBy("report_key", "item_no").collect()
    a = [r.item for r in out if r.report_key == "a"]
    assert a == ["**Fix the cart**", "Add live chat. Soon", "Improve dispatch", "Re-check sign-up flow"]
    b = [r.item for r in out if r.report_key == "b"]
    assert b == list(reports.FALLBACK_ACTIONS)


def test_first_wins_dedupe(spark):
    df = spark.createDataFrame([("x", 2), ("y", 1), ("x", 1)], "item string, pos int")
    out = {r.item: r.first_pos for r in reports.first_wins_dedupe(df, "item", ["pos"], add=["y", "z"]).collect()}
    assert out == {"x": 1, "y": 1, "z": None}


def test_search_reviews(spark, golden):
    clean = clean_reviews(golden)
    hits = {r.review_id for r in search.search_reviews(clean, "COLD").collect()}
    assert hits == {2, 12}
    assert search.search_reviews(clean, "worth").count() == 1  # title only
    assert search.search_reviews(clean, "a.b", literal=True).count() == 0
    assert search.search_reviews(clean, "c(o|a)ll").count() >= 1
    with pytest.raises(ValueError):
        search.search_reviews(clean, "(")


def test_facet_filter_and_display(golden):
    df = search.default_theme(golden)
    assert search.facet_filter(df, source="appstore", rating="1").count() == 2
    assert search.facet_filter(df, rating=3).count() == 0
    shown = search.display_projection(df).where(F.col("rating") == "N/A").count()
    assert shown == 9


def test_metrics(golden):
    dist = [(r.rating, r.n_reviews) for r in metrics.ratings_distribution(golden).collect()]
    assert dist == [(1, 2), (2, 2), (5, 1)]
    share = metrics.channel_share(golden).collect()
    assert share[0].source == "appstore" and share[0].n_reviews == 4
    assert abs(sum(r.share for r in share) - 1.0) < 1e-12
    facets = metrics.facet_values(search.default_theme(golden)).collect()
    assert {(r.facet, r.value) for r in facets if r.facet == "rating"} == {("rating", "1"), ("rating", "2"), ("rating", "5")}


def test_weekly_note_sections(golden):
    notes = reports.weekly_note(
        themes.assign_themes(clean_reviews(golden), THEME_TERMS, THEME_NAMES), questions=QUESTION_TERMS)
    rows = notes.collect()
    assert {r.source for r in rows} == {"appstore", "playstore", "reddit", "linkedin", "twitter"}
    n = rows[0].note
    for part in ("## Top Themes", "## User Quotes", "## Strategic Action Ideas", "## Product Questions"):
        assert part in n
    items = reports.parse_action_items(notes)
    assert items.where(F.col("item").startswith("**Investigate")).count() == items.count()


def test_number_within_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    got = number_within(df, ["g"], [F.col("v").desc(), F.col("id")])
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")))
    a = sorted((r.id, r.rn) for r in got.select("id", "rn").collect())
    b = sorted((r.id, r.rn) for r in want.select("id", "rn").collect())
    assert a == b


def test_top_k_uses_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    top = top_k_within(df, ["g"], [F.col("id").desc()], 2)
    assert sorted((r.g, r.id) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_theme_assignment_ties_and_fallback(spark):
    df = spark.createDataFrame([(1, "the der"), (2, "nothing"), (3, "que los el and")],
                               "review_id long, text string")
    out = {r.review_id: r.theme_id for r in themes.assign_themes(df, THEME_TERMS, THEME_NAMES).collect()}
    assert out == {1: "theme_alpha", 2: "theme_general", 3: "theme_gamma"}
    pairs = themes.theme_lexicon_join(df, THEME_TERMS).count()
    assert pairs == 6


def _lexicon_rows(lexicon, key, spark):
    """As a table with repeats, nulls and many terms that no text has."""
    rows = [(k, t) for k in lexicon for t in lexicon[k]] * 2 + [(None, "the"), ("x", None)]
    rows += [(k, f"none{i}") for i in range(1500) for k in lexicon]
    return spark.createDataFrame(rows, f"{key} string, term string")


@pytest.mark.parametrize("parts", [1, 8])
def test_lexicon_tables_give_what_small_dicts_give(spark, parts):
    """Themes, pairs, question evidence and notes; common words are in more than half of the rows, so
    they are split over tasks."""
    from feedlens.sources import tables
    from tests.conftest import SF001
    clean = clean_reviews(tables.reviews(spark, SF001))
    extra = spark.createDataFrame([(None, "reddit", None, None, "The and THE der", None), (5, "reddit", 1, "t", "", None)] * 2, clean.schema)
    clean = clean.unionByName(extra)
    theme_table, question_table = _lexicon_rows(THEME_TERMS, "theme_id", spark), _lexicon_rows(QUESTION_TERMS, "question_key", spark)
    big = {k: [*v, *(f"none{i}" for i in range(1500))] for k, v in QUESTION_TERMS.items()}  # beyond the inline limit
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert rows(themes.theme_lexicon_join(clean, theme_table)) == rows(themes.theme_lexicon_join(clean, THEME_TERMS))
        want = rows(themes.question_evidence(clean, QUESTION_TERMS, by=("source",)))
        assert rows(themes.question_evidence(clean, question_table, by=("source",))) == want
        assert rows(themes.question_evidence(clean, big, by=("source",))) == want
        inline = themes.assign_themes(clean, THEME_TERMS, THEME_NAMES, questions=QUESTION_TERMS)
        joined = themes.assign_themes(clean, theme_table, THEME_NAMES, questions=question_table)
        assert rows(joined) == rows(inline)
        dated = themes.assign_themes(clean.where("date is not null"), THEME_TERMS, THEME_NAMES)
        notes = rows(reports.weekly_note(dated, questions=QUESTION_TERMS))
        assert rows(reports.weekly_note(dated, questions=question_table)) == notes
        assert rows(reports.weekly_note(dated, questions=big)) == notes
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    nothing = question_table.where("term = 'none'")
    assert {r.answer for r in themes.question_evidence(clean, nothing).collect()} == {"No analysis available."}
    assert themes.theme_lexicon_join(clean.where("review_id < 0"), theme_table).count() == 0
