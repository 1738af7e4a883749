"""Dashboard metrics (A1-A4, F6): partial/final hash aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.text import has_mask_marker


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """A1: one row: total rows, mean rating over non-null ratings (2 dp,
    NULL when there is none), rows carrying a mask marker, distinct
    non-null sources.  Input should already be masked (see P2)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
        F.count_if(has_mask_marker("text")).alias("masked_rows"),
        F.countDistinct("source").alias("active_channels"),
    )


def channel_share(df: DataFrame) -> DataFrame:
    """A2: rows per source and share of all rows, largest first (ties by
    source).  The window over () runs on the aggregated rows: one per source.
    """
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n_reviews"))
    total = F.sum("n_reviews").over(Window.partitionBy())
    return (counts.withColumn("share", F.col("n_reviews") / total)
            .orderBy(F.col("n_reviews").desc(), F.col("source")))


def rated_only(df: DataFrame) -> DataFrame:
    """rows that carry a rating."""
    return df.where(F.col("rating").isNotNull())


def ratings_distribution(df: DataFrame) -> DataFrame:
    """A3: rows per rating value, NULL ratings excluded, by rating."""
    return (rated_only(df).groupBy("rating").agg(F.count(F.lit(1)).alias("n_reviews"))
            .orderBy("rating"))


def facet_values(df: DataFrame, theme_col: str = "theme") -> DataFrame:
    """A4: the option lists of the filter boxes as ``facet, value`` rows:
    distinct sources, distinct non-null ratings, distinct themes: one pass
    over the rows, one distinct aggregate, sorted by facet and value."""
    facets = ["source", "rating", *([theme_col] if theme_col in df.columns else [])]
    pairs = F.array(*(F.struct(F.lit("theme" if c == theme_col else c).alias("facet"),
                               F.col(c).cast("string").alias("value")) for c in facets))
    return (df.select(F.explode(pairs).alias("f")).select("f.facet", "f.value")
            .where(F.col("value").isNotNull()).distinct().orderBy("facet", "value"))
