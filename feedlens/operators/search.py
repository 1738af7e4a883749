"""Search-feed operators: facets, regex search, theme default, display
projection and previews (F4, F5, P5, P6, P7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.lexicon import FALLBACK_THEME
from feedlens.functions.text import check_regex

ALL = "All"
PREVIEW_CHARS = 60
DISPLAY_COLUMNS = ("source", "rating", "theme", "title", "text", "date")


def default_theme(df: DataFrame, col: str = "theme") -> DataFrame:
    """P5: a missing theme column or a NULL theme becomes the fallback."""
    if col not in df.columns:
        return df.withColumn(col, F.lit(FALLBACK_THEME))
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(FALLBACK_THEME)))


def facet_filter(df: DataFrame, source: str = ALL, rating=ALL, theme: str = ALL) -> DataFrame:
    """conjunction of equality filters; 'All' means no filter.  A NULL
    rating never equals a chosen rating."""
    out = df
    if source != ALL:
        out = out.where(F.col("source") == F.lit(source))
    if str(rating) != ALL:
        out = out.where(F.col("rating") == F.lit(int(rating)))
    if theme != ALL:
        out = out.where(F.col("theme") == F.lit(theme))
    return out


def search_reviews(df: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """case-insensitive regex match on text OR title; NULL never matches.

    The pattern is compiled once first, so a bad pattern fails
    before a job starts.  ``literal=True`` searches for the plain string.
    """
    if not pattern:
        return df
    if literal:
        import re
        pattern = re.escape(pattern)
    check_regex(df.sparkSession, pattern)
    rx = "(?iu)" + pattern
    hit = (F.coalesce(F.col("text").rlike(rx), F.lit(False))
           | F.coalesce(F.col("title").rlike(rx), F.lit(False)))
    return df.where(hit)


def display_projection(df: DataFrame) -> DataFrame:
    """The feed columns; rating rendered as text, NULL -> 'N/A'."""
    df = default_theme(df)
    return df.select(
        "source",
        F.coalesce(F.col("rating").cast("string"), F.lit("N/A")).alias("rating"),
        "theme", "title", "text", "date")


def preview_lines(df: DataFrame, chars: int = PREVIEW_CHARS) -> DataFrame:
    """``- [SOURCE] (date): <first 60 chars>...`` per review."""
    line = F.concat(F.lit("- ["), F.upper("source"), F.lit("] ("),
                    F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
                    F.lit("): "), F.substring(F.coalesce(F.col("text"), F.lit("")), 1, chars),
                    F.lit("..."))
    return df.select("review_id", line.alias("preview"))
