"""Landing folders and the search index: what is read, and equal results."""

import datetime as dt
import glob
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import GOLDEN_AS_OF, SF001
from feedlens.operators import ingest, search
from feedlens.operators.search_index import SearchIndex, needed_runs, runs_of
from feedlens.operators.privacy import clean_reviews
from feedlens.sources import landing, tables


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def spoil(paths):
    for path in paths:
        with open(path, "wb") as f:
            f.write(b"no parquet")


@pytest.mark.parametrize("weeks", [1, 2])
def test_a_window_reads_only_its_own_folders(spark, golden, tmp_path, weeks):
    undated = golden.limit(2).withColumns({"date": F.lit(None).cast("timestamp_ntz"), "source": F.lit(None).cast("string")})
    rows = golden.unionByName(undated)
    path = str(tmp_path / "land")
    landing.land(rows, path)
    assert rows_of(landing.scan_landing(spark, path, rows.schema).drop("week")) == rows_of(rows)
    want = rows_of(ingest.rolling_window(rows, GOLDEN_AS_OF, weeks))
    assert rows_of(landing.scan_window(spark, path, rows.schema, GOLDEN_AS_OF, weeks)) == want
    reddit = landing.scan_window(spark, path, rows.schema, GOLDEN_AS_OF, weeks, ("reddit",))
    assert rows_of(reddit) == [r for r in want if "reddit" in r]
    plan = reddit._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*week", plan) and re.search(r"PartitionFilters: \[[^\]]*source", plan)
    # Files of earlier weeks are not even opened.
    start = dt.date(2026, 7, 7) - dt.timedelta(weeks=weeks)
    monday = start - dt.timedelta(days=start.weekday())
    earlier = [f for f in glob.glob(f"{path}/*/*/*.parquet") if not re.search(r"week=\d", f) or f.split("week=")[1][:10] < str(monday)]
    assert earlier
    spoil(earlier)
    assert rows_of(landing.scan_window(spark, path, rows.schema, GOLDEN_AS_OF, weeks)) == want


def test_landing_again_replaces_weeks_or_adds(spark, golden, tmp_path):
    path = str(tmp_path / "land")
    landing.land(golden, path)
    landing.land(golden.where("source = 'reddit'"), path, replace_weeks=True)
    assert landing.scan_landing(spark, path, golden.schema).count() == 14
    landing.land(golden.where("source = 'reddit'"), path)
    assert landing.scan_landing(spark, path, golden.schema).count() == 18
    assert landing.scan_window(spark, str(tmp_path / "absent"), golden.schema, GOLDEN_AS_OF).count() == 0


def test_feed_from_landing_equals_the_feed(spark, tmp_path):
    reviews = tables.reviews(spark, SF001)
    feed = tables.appstore_feed(reviews, 5, 10).withColumn("source", F.lit("appstore"))
    path = str(tmp_path / "feed")
    landing.land(feed, path)
    as_of = tables.latest_date(reviews)
    want = rows_of(ingest.feed_take_while(feed, as_of, 1))
    assert want and rows_of(landing.feed_in_window(spark, path, feed.schema, as_of, 1)) == want


# ---------------------------------------------------------------- search

def test_needed_runs():
    assert needed_runs("email") == ("and", ("ema", "mai", "ail"))
    assert needed_runs("ver(y|s)|Email") == ("or", ("ver", ("and", ("ema", "mai", "ail"))))
    assert needed_runs("(?:cold)+ food?") == ("and", (("and", ("col", "old")), " fo", "foo"))
    assert needed_runs(r"a\.bc") == ("and", ("a.b", ".bc"))
    assert runs_of(needed_runs("c(o|a)ll")) == set()
    for open_ in ("", "ab", "a.c", "abc|", "(abc)?", "(abc)*", "[abc]def|x", "straße", "(?i)abc", r"\Qabc\E", r"\p{L}bcd", "a{3}",
                  "(?=abc)", "(?!abc)", r"(abc)\1", "[a&&b]cde", r"\x41bcd", "(abc", "abc#", "abc}"):
        assert needed_runs(open_) is None, open_
    assert needed_runs("abc{0}") is None and needed_runs("xabc{2}") == "xab"


PATTERNS = ["email", "COLD", "c(o|a)ll", "(?:cold|late) fo+d", "zzzzzz", "kel", "sta", "ist", r"a\.b", "", "straße", "STRASSE",
            r"\Qa.b\E", "o d", "(abc)?def", "end\nnext", "de(f|g)(hij)+"]


def test_index_finds_what_the_scan_finds(spark, tmp_path):
    rows = [(1, "Cold food, cold again", None), (2, "KELVIN Kelvin", "x"), (3, "laſt ſtatus", "is it"), (4, "dİstance ıstı", None),
            (5, "Straße STRASSE strasse", ""), (6, None, "Title only email"), (7, "", ""), (8, "a.b acb", None), (None, "food without id", None),
            (None, "cold without id", "t"), (9, "dup food", None), (9, "dup late food", "kk"), (10, "Σσς sigma", None), (11, "ends", "food"),
            (12, "end\nnext", "abcdef defhijhij"), (13, "th", "e"), (14, "the " * 20000 + "very", None)]
    df = spark.createDataFrame(rows, "review_id long, text string, title string").repartition(3)
    index = SearchIndex(spark, str(tmp_path / "ix"), df.schema, gram_folders=4, row_folders=4).build(df)
    for pattern in PATTERNS:
        assert rows_of(index.search(pattern)) == rows_of(search.search_reviews(df, pattern)), pattern
    with pytest.raises(ValueError):
        index.search("(")


def test_index_equals_the_scan_for_words_of_the_texts(spark, tmp_path):
    df = clean_reviews(tables.reviews(spark, SF001)).select("review_id", "source", "title", "text")
    index = SearchIndex(spark, str(tmp_path / "ix"), df.schema, gram_folders=8, row_folders=64).build(df)
    texts = [r.text for r in df.collect()]
    rng = random.Random(2)
    for _ in range(4):
        text = rng.choice(texts)
        at = rng.randrange(max(1, len(text) - 8))
        pattern = re.escape(text[at:at + rng.choice([4, 8])])
        assert rows_of(index.search(pattern)) == rows_of(search.search_reviews(df, pattern)), pattern
    # Only the folders of candidates are read.
    rare = next(w for w in sorted({w for t in texts for w in re.findall("[a-z]{6,}", t)}, key=len, reverse=True))
    want = rows_of(search.search_reviews(df, rare))
    used = {r[0] for r in df.where(F.col("text").contains(rare)).select(F.pmod(F.xxhash64("review_id"), F.lit(64))).collect()}
    spoil(f for f in glob.glob(str(tmp_path / "ix/rows/folder=*/*.parquet"))
          if int(re.search(r"folder=(\d+)", f)[1]) not in {r[0] for r in index.candidates(needed_runs(rare)).select(
              F.pmod(F.xxhash64("review_id"), F.lit(64))).collect()} | used)
    assert rows_of(index.search(rare)) == want


def test_postings_are_lists(spark, tmp_path):
    """a run has one row for many reviews, and the runs are those of the folded characters."""
    rows = [(i, "Abc" + "d" * (i % 3) if i % 5 else None, "é€ tİtle" if i % 2 else None) for i in range(60)] + [(None, "abc", "a\u20acbcd")]
    df = spark.createDataFrame(rows, "review_id long, text string, title string").coalesce(1)
    SearchIndex(spark, str(tmp_path / "ix"), df.schema, gram_folders=2, row_folders=2).build(df)
    found = spark.read.parquet(str(tmp_path / "ix/postings"))
    pairs = [(r.run, i) for r in found.collect() for i in r.review_ids]
    want = set()
    for i, text, title in rows:
        both = (text or "").lower() + "\n" + (title or "").translate(str.maketrans("\u0130", "i")).lower()
        want |= {(both[j:j + 3], i) for j in range(len(both) - 2) if both[j:j + 3].isascii()}
    assert len(pairs) == len(want) and set(pairs) == want
    assert found.count() < len(want) / 2


def test_index_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "review_id string, text string, title string")
    index = SearchIndex(spark, str(tmp_path / "ix"), df.schema).build(df)
    assert index.search("email").count() == 0 and index.search("x*").count() == 0
