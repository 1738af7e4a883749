"""Declared schemas.  Every reader uses one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Review as it lands in a JSON dump: every field is text.  Ids are the channels'
# own, dates ISO-8601, ratings may be anything (they are coerced with try_cast).
REVIEW_RAW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.StringType()),
])

_LABEL = T.StructType([T.StructField("label", T.StringType())])

# One app-store feed entry; every leaf is a string label.
FEED_ENTRY = T.StructType([
    T.StructField("id", _LABEL),
    T.StructField("updated", _LABEL),
    T.StructField("im:rating", _LABEL),
    T.StructField("title", _LABEL),
    T.StructField("content", _LABEL),
])

# Play-store export record.
PLAYSTORE = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("content", T.StringType()),
    T.StructField("at", T.TimestampNTZType()),
])

THEME = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
])

ASSIGNMENT = T.StructType([
    T.StructField("review_index", T.IntegerType()),
    T.StructField("theme_id", T.StringType()),
])

TOP_THEME = T.StructType([
    T.StructField("rank", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("rationale", T.StringType()),
])

WEEKLY_NOTE = T.StructType([
    T.StructField("top_themes", T.ArrayType(TOP_THEME)),
    T.StructField("user_quotes", T.ArrayType(T.StringType())),
    T.StructField("action_ideas", T.ArrayType(T.StringType())),
])

# The analysis payload returned by a completion function.
PAYLOAD = T.StructType([
    T.StructField("themes", T.ArrayType(THEME)),
    T.StructField("clustering", T.ArrayType(ASSIGNMENT)),
    T.StructField("question_answers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("weekly_note", WEEKLY_NOTE),
    T.StructField("_corrupt", T.StringType()),
])

# Theme dimension as exported to CSV (header names are the file's).
THEMES_CSV = T.StructType([
    T.StructField("Theme ID", T.StringType()),
    T.StructField("Theme Name", T.StringType()),
    T.StructField("Description", T.StringType()),
])
