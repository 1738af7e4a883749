"""Term lexicons: themes or questions with the terms that speak for them.

A lexicon is a dict or a table of any size.  Small dicts are applied as a
per-row projection (no shuffle); the join form of the same rule lives in
``feedlens.operators.themes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.text import let, tokens

# --- fixed values: fallback theme, question keys and labels ---
FALLBACK_THEME_ID = "theme_general"
FALLBACK_THEME = "General / Uncategorized"

# the six business questions, in report order, with their labels
QUESTIONS = (
    ("struggle_points", "What are the users' struggle points on the app?"),
    ("ordering_frustrations", "What are the most common frustrations while ordering?"),
    ("delivery_partner_and_user_issues", "What problems are delivery partners and users facing?"),
    ("switch_causes_and_loyalty_barriers", "What causes them to switch to competitors & blocks loyalty?"),
    ("discovery_challenges", "Which user segments experience different discovery challenges?"),
    ("unmet_needs", "What unmet needs emerge consistently?"),
)
NO_ANSWER = "No analysis available."
# --- end of fixed values ---

# A dict with up to this many terms is applied inside the row; beyond it, and for
# a table, texts and terms are joined (``operators.themes.term_pairs``).
INLINE_TERM_LIMIT = 2000

Lexicon = dict | DataFrame


def is_small(lexicon: Lexicon) -> bool:
    return isinstance(lexicon, dict) and sum(len(v) for v in lexicon.values()) <= INLINE_TERM_LIMIT


def lexicon_frame(spark: SparkSession, lexicon: Lexicon, key: str = "theme_id") -> DataFrame:
    """The lexicon as a table ``key, term`` without nulls and repeats.  A dict is
    ``{key: terms}``; a table may have any size."""
    if isinstance(lexicon, DataFrame):
        return lexicon.select(key, "term").where(F.col(key).isNotNull() & F.col("term").isNotNull()).distinct()
    rows = [(k, t) for k in sorted(lexicon) for t in sorted(set(lexicon[k]))]
    return spark.createDataFrame(rows, f"{key} string, term string")


def term_count(tok: Column, terms) -> Column:
    """Number of distinct ``terms`` present in a distinct-token array."""
    return F.size(F.array_intersect(tok, F.array(*[F.lit(t) for t in sorted(set(terms))])))


def pick_best(tok: Column, lexicon: dict, fallback: str | None) -> Column:
    """``struct(key, score)`` from a distinct-token array: the key with the
    most matched terms, ties to the smallest key, ``fallback``/0 if none."""
    cands = F.array(*[
        F.struct((-term_count(tok, lexicon[k])).alias("neg"), F.lit(k).alias("key"))
        for k in sorted(lexicon)
    ])
    return let(F.array_min(cands), lambda b: F.struct(
        F.when(b["neg"] < 0, b["key"]).otherwise(F.lit(fallback)).alias("key"),
        (-b["neg"]).cast("bigint").alias("score")))


def key_scores(tok: Column, lexicon: dict, name: str = "question_key") -> Column:
    """``array<struct<name, score>>`` of the keys with at least one matched
    term (score = distinct matched terms), in key order."""
    arr = F.array(*[F.struct(F.lit(k).alias(name), term_count(tok, lexicon[k]).alias("score"))
                    for k in sorted(lexicon)])
    return F.filter(arr, lambda s: s["score"] > 0)


def best_match(text: Column, lexicon: dict, fallback: str | None) -> Column:
    """``pick_best`` on a text; the token array is built once per row."""
    return let(tokens(text), lambda tok: pick_best(tok, lexicon, fallback))


def best_key(text: Column, lexicon: dict, fallback: str | None) -> Column:
    return best_match(text, lexicon, fallback)["key"]
