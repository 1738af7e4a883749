"""Landing tables of the bundled data set and the review views built on them.

The synthetic tables carry no app reviews, so ``reviews`` shapes one review
per document: the matching event gives channel, rating and time.  The view
is the base of almost every registered query.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# --- fixed values: channel of each event type, and the title length ---
CHANNEL_OF_EVENT = {"click": "playstore", "view": "appstore",
                    "purchase": "reddit", "signup": "linkedin"}
OTHER_CHANNEL = "twitter"
RATED_EVENTS = ("click", "view")
UNTITLED_EVENT = "error"
# The bundled texts have no title; the first characters serve as one.
TITLE_CHARS = 40
DOC_EVENT_STRIDE = 5
# --- end of fixed values ---

SOURCES = ("playstore", "appstore", "reddit", "linkedin", "twitter")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_id, source, rating, title, text, date`` (one row per document).

    An equi-join on ``event_id = doc_id * 5``; Spark picks the strategy, and no
    text is moved that the join does not move.  Only documents that arrive in fewer
    partitions than there are cores (one small file with one row group) are
    spread first, on the join key; else one task would mask and tokenise
    them all.  The projections prune the scans to the five columns used.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    if docs.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        docs = docs.repartition(F.col("doc_id") * DOC_EVENT_STRIDE)
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    joined = docs.join(events, events.event_id == docs.doc_id * DOC_EVENT_STRIDE)
    etype = F.col("event_type")
    source = F.lit(OTHER_CHANNEL)
    for event, channel in reversed(list(CHANNEL_OF_EVENT.items())):
        source = F.when(etype == event, channel).otherwise(source)
    rating = F.when(etype.isin(*RATED_EVENTS),
                    (F.lit(1) + F.floor(F.abs(F.col("value"))).cast("bigint") % 5).cast("int"))
    title = F.when(etype != UNTITLED_EVENT, F.substring("text", 1, TITLE_CHARS))
    # The text is taken from the joined row (the join key is never NULL
    # there, so the value is unchanged).  A predicate on a text-derived
    # value (theme, search pattern, mask marker) then references both sides
    # and stays above the join: it runs on the rows the selective event-side
    # filters leave, not on every document before the join.  Catalyst
    # treats every filter as cheap; masking and tokenising are not.
    text = F.when(F.col("event_id").isNotNull(), F.col("text"))
    return joined.select(
        F.col("doc_id").alias("review_id"),
        source.alias("source"),
        rating.alias("rating"),
        title.alias("title"),
        text.alias("text"),
        F.col("ts").alias("date"),
    )


def latest_date(df: DataFrame, col: str = "date") -> _dt.datetime:
    """The newest timestamp of a frame: one tiny aggregate, returned as a
    literal so that later window filters fold to constants and reach the
    parquet scan as pushed filters."""
    return df.agg(F.max(col)).first()[0]


def appstore_feed(reviews_df: DataFrame, page_size: int, stray_every: int) -> DataFrame:
    """``review_id, page, rating, title, text, date`` of the appstore channel
    as a paged feed: pages of ``page_size`` rows, newest first; reviews with
    an id divisible by ``stray_every`` are stray rows on a page behind all
    others, which a reader that stops early never sees."""
    from feedlens.operators.ordering import number_within

    app = reviews_df.where(F.col("source") == "appstore").withColumn(
        "stray", F.col("review_id") % stray_every == 0)
    rows = number_within(app, ["stray"], [F.col("date").desc(), "review_id"], name="rn")
    page = F.floor((F.col("rn") - 1) / F.lit(page_size)) + 1
    last = rows.where("not stray").agg(F.coalesce(F.max(page), F.lit(0))).scalar()
    return rows.select("review_id", F.when(F.col("stray"), last + 1).otherwise(page).cast("bigint").alias("page"),
                       "rating", "title", "text", "date")
