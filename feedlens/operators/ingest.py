"""Ingestion operators: window, date rejects, source precedence, union,
feed take-while, newest-N, resampling and per-source counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.dates import parse_date, window_start
from feedlens.session import checkpoint_root

# --- fixed values: the window ---
DEFAULT_WEEKS = 7
# --- end of fixed values ---
# Source priority of the consolidated list: play store, app store, social.
PRIORITY = {"playstore": 1, "appstore": 2}
SOCIAL_PRIORITY = 3


def rolling_window(df: DataFrame, as_of, weeks: int = DEFAULT_WEEKS,
                   col: str = "date") -> DataFrame:
    """keep ``col >= as_of - weeks`` (inclusive, no upper bound).

    With a literal ``as_of`` the bound folds to a constant and reaches the
    parquet scan as a pushed filter.
    """
    return df.where(F.col(col) >= window_start(as_of, weeks))


def split_on_dates(df: DataFrame, raw_col: str = "date_raw",
                   out_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """parse ISO date strings; return (kept, rejected).

    One projection computes the parsed value; both outputs filter it, so
    the parse never fails a task (``try_to_timestamp``)."""
    parsed = df.withColumn(out_col, parse_date(raw_col))
    return parsed.where(F.col(out_col).isNotNull()), parsed.where(F.col(out_col).isNull())


def source_precedence(primary: DataFrame, fallback: DataFrame,
                      store_sources=("playstore", "appstore")) -> DataFrame:
    """drop fallback rows of a store source that has any primary rows.

    A left-anti join against the distinct store sources of ``primary``.
    That side has at most ``len(store_sources)`` rows (an ``isin`` filter
    and a distinct), a proven bound, so it is broadcast: a shuffle join on
    a five-valued key would put a whole channel into one task.
    """
    present = primary.select("source").where(F.col("source").isin(*store_sources)).distinct()
    return fallback.join(F.broadcast(present), on="source", how="left_anti")


def consolidate(tagged: DataFrame, store_sources=("playstore", "appstore")) -> DataFrame:
    """U1 and F3 in one pass: ``tagged`` holds crawl and dump rows with a
    boolean ``crawled``.  Dump rows of a store that was crawled go; the rest
    gets ``priority`` (1 play store, 2 app store, 3 the others, and all dump
    rows).  Which stores were crawled is one row of at most two names."""
    present = (tagged.where("crawled").where(F.col("source").isin(*store_sources))
               .agg(F.collect_set("source").alias("present")).scalar())
    priority = F.when(F.col("crawled") & (F.col("source") == "playstore"), 1).when(
        F.col("crawled") & (F.col("source") == "appstore"), 2).otherwise(SOCIAL_PRIORITY)
    return (tagged.where(F.col("crawled") | ~F.coalesce(F.array_contains(present, F.col("source")), F.lit(False)))
            .withColumn("priority", priority))


def union_sources(play: DataFrame, app: DataFrame, social: DataFrame) -> DataFrame:
    """Bag union of the three inputs with a ``priority`` column
    (1 play store, 2 app store, 3 the rest)."""
    cols = ["review_id", "source", "rating", "title", "text", "date"]
    return (play.select(*cols).withColumn("priority", F.lit(1))
            .unionByName(app.select(*cols).withColumn("priority", F.lit(2)))
            .unionByName(social.select(*cols).withColumn("priority", F.lit(SOCIAL_PRIORITY))))


def feed_take_while(feed: DataFrame, as_of, weeks: int = DEFAULT_WEEKS, by: tuple = ()) -> DataFrame:
    """Pages are read in order and reading stops at the first page that
    contributes no in-window row (an empty or missing page stops it too).
    A row survives when it is in the window and every page up to its own
    contributed at least one row.

    The stop page follows the first good page whose successor is not good,
    if page 1 is good.  The good pages are one row per page, written once;
    what follows are hash joins and aggregates on (group, page), so a feed of
    any length spreads over all tasks.
    """
    by = list(by)
    checkpoint_root(feed.sparkSession)
    in_win = feed.where(F.col("date") >= window_start(as_of, weeks))
    good = in_win.select(*by, "page").distinct().checkpoint()
    before = good.select(*by, (F.col("page") - 1).alias("page"))
    ends = good.join(before, on=[*by, "page"], how="left_anti")
    stop = (ends.groupBy(*by).agg((F.min("page") + 1).alias("stop_page"))
            if by else ends.agg((F.min("page") + 1).alias("stop_page")))
    if by:
        stop = stop.join(good.where("page = 1").select(*by), on=by, how="left_semi")
    elif good.where("page = 1").isEmpty():
        return in_win.where(F.lit(False))
    kept = _join_single(in_win, stop, by)
    return kept.where(F.col("page") < F.col("stop_page")).drop("stop_page")


def _join_single(rows: DataFrame, stop: DataFrame, by: list) -> DataFrame:
    if by:
        return rows.join(stop, on=by, how="inner")
    # A single feed: the stop page is one scalar.  Attach it as a scalar
    # subquery rather than pairing rows with a one-row table.
    return rows.withColumn("stop_page", stop.select("stop_page").scalar())


def newest_n(df: DataFrame, n: int) -> DataFrame:
    """L1: the ``n`` newest rows.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: every task
    keeps its own top n and only those reach the final merge."""
    return df.orderBy(F.col("date").desc(), F.col("review_id")).limit(n)


def resample(df: DataFrame, rate: float, seed: int, id_col: str = "review_id") -> DataFrame:
    """Every row once (``draw`` 0) and a further copy (``draw`` 1) of the
    rows whose draw, a hash of seed and id, falls below ``rate``.

    Values are not altered.  The same rule holds at every size; it is a
    projection without a count or a shuffle."""
    limit = format(int(rate * 16 ** 8), "08x")
    drawn = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"))), 1, 8) < F.lit(limit)
    return df.withColumn("draw", F.explode(F.when(drawn, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def source_window_counts(df: DataFrame, as_of, weeks: int = DEFAULT_WEEKS,
                         date_col: str = "date") -> DataFrame:
    """A5: per source: rows seen, rows kept by the window, rows rejected
    for an unparseable (NULL) date."""
    start = window_start(as_of, weeks)
    d = F.col(date_col)
    return (df.groupBy("source")
            .agg(F.count(F.lit(1)).alias("seen"),
                 F.count_if(d >= start).alias("kept"),
                 F.count_if(d.isNull()).alias("rejected")))
