"""Plan-shape checks, and brute-force checks of theme names and quotes."""

from pyspark.sql import functions as F

from feedlens.operators import discover, search, themes
from feedlens.operators.privacy import clean_reviews
from feedlens.sources import tables
from feedlens.plans.params import THEME_NAMES, THEME_TERMS

from conftest import SF001, SF01


def test_theme_names_match_brute_force(spark):
    rows = [(1, 0, ["cold", "food", "food"]), (2, 0, ["cold", "late"]), (3, 1, ["price", "food"]), (4, 1, ["price"]),
            (5, 1, []), (6, 2, [])]
    named = discover._names(spark.createDataFrame(rows, "review_id long, prediction int, _terms array<string>")).collect()
    want = {}
    for c in (0, 1, 2):
        own, rest = [set(t) for _, p, t in rows if p == c], [set(t) for _, p, t in rows if p != c]
        apart = {t: sum(t in s for s in own) / len(own) - sum(t in s for s in rest) / len(rest) for s in own for t in s}
        want[c] = " / ".join(sorted(apart, key=lambda t: (-apart[t], t))[:discover.NAME_TERMS]) or f"cluster {c + 1}"
    assert {r.prediction: r.theme for r in named} == want
    assert [r.theme_id for r in sorted(named)] == ["theme_1", "theme_2", "theme_3"]


def test_quotes_aggregate_no_text(spark):
    """The choice of quotes sends numbers only, and the texts are read back
    with the semi join on the chosen ids below the masking."""
    themed = themes.assign_themes(clean_reviews(tables.reviews(spark, SF001)), THEME_TERMS, THEME_NAMES)
    quotes = themes.representative_quotes(themed)
    plan = quotes._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    assert any("regexp_replace" in line for line in plan[:semi])
    # Rows without an id are read by a filter of their own, at the scan.
    assert any("isnull(doc_id" in line for line in plan)
    want = {}
    for r in themed.collect():
        rank = (-r.theme_score, len(r.text), r.review_id, r.text)
        key = (r.source, r.theme_id)
        want[key] = min(want.get(key, rank), rank)
    assert {(r.source, r.theme_id): (r.review_id, r.quote) for r in quotes.collect()} == {
        k: v[2:] for k, v in want.items()}


def test_quotes_of_rows_without_or_with_repeated_ids(spark):
    rows = [("a", None, "no id", 2), ("a", None, "no id either", 2), ("b", 7, "first", 1), ("b", 7, "again", 1),
            ("c", 7, "elsewhere", 1)]
    themed = spark.createDataFrame(rows, "source string, review_id long, text string, theme_score long").selectExpr(
        "*", "'t' as theme_id", "'T' as theme")
    got = {r.source: (r.review_id, r.quote) for r in themes.representative_quotes(themed).collect()}
    assert got == {"a": (None, "no id"), "b": (7, "again"), "c": (7, "elsewhere")}


def test_text_predicates_run_after_the_review_join(spark):
    """A filter on the theme or a search pattern must not be pushed onto the
    documents scan, where it would mask and tokenise every document before
    the selective event-side filters apply."""
    themed = themes.assign_themes(clean_reviews(tables.reviews(spark, SF001)), THEME_TERMS, THEME_NAMES)
    for df in (search.facet_filter(themed, source="appstore", rating=4, theme="English-language feedback"),
               search.search_reviews(search.facet_filter(themed, source="reddit"), "order")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.split("\n") if "Filter" in line]
        assert not any("array_distinct" in f or "RLIKE" in f or "regexp_replace" in f for f in filters), filters
        # the event-side filters still reach the events scan
        assert "event_type" in " ".join(filters)


def test_quote_read_back_filters_at_the_documents_scan(spark):
    """The weekly note reads back only its chosen quotes: the IN-subquery
    filter must become a semi join on the documents side, below the
    repartition and the masking projection."""
    themed = themes.assign_themes(clean_reviews(tables.reviews(spark, SF001)), THEME_TERMS, THEME_NAMES)
    picked = spark.range(3).select((F.col("id") + 5).alias("quote_id"))
    quotes = spark.sql("SELECT review_id AS quote_id, text AS quote FROM {reviews} "
                       "WHERE review_id IN (SELECT quote_id FROM {picked})",
                       reviews=themed.select("review_id", "text"), picked=picked)
    plan = quotes._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    repart = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    masking = next(i for i, line in enumerate(plan) if "regexp_replace" in line)
    assert masking < repart < semi  # printed top-down: the semi join is the deepest
    assert sorted(r.quote_id for r in quotes.collect()) == [5, 6, 7]


def test_review_view_moves_no_text_that_comes_in_many_partitions(spark, tmp_path):
    """Masked rows and searches over documents in many files: no exchange of text
    below the test, and equal rows either way."""
    from feedlens.operators import privacy
    few = tables.reviews(spark, SF001)
    for name in ("documents", "events"):
        spark.read.parquet(f"{SF001}/{name}.parquet").repartition(40).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        many = tables.reviews(spark, str(tmp_path))
        key = lambda df: sorted(map(tuple, df.collect()), key=repr)
        for query in (lambda r: privacy.pii_marked_rows(clean_reviews(r)), lambda r: search.search_reviews(clean_reviews(r), "email")):
            assert "REPARTITION" in query(few)._jdf.queryExecution().executedPlan().toString()
            assert "REPARTITION" not in query(many)._jdf.queryExecution().executedPlan().toString()
            assert key(query(many)) == key(query(few))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_explode_payload_covers_every_batch(spark):
    """the payload rows are those of all batches, refused and cut replies included."""
    from feedlens.plans.catalog import REGISTRY

    batches = REGISTRY["annotate_batches"](spark, SF01).select("source", "batch")
    rows = REGISTRY["explode_payload"](spark, SF01)
    missing = batches.join(rows.where("kind = 'assignment'").select("source", "batch").distinct(), ["source", "batch"], "left_anti")
    assert missing.count() == 0
    assert rows.where("kind = 'assignment'").count() == REGISTRY["number_reviews"](spark, SF01).count()
