"""Text column expressions: contact masking, tokens, regex checks.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- fixed values: these must equal the reference's for identical masking ---
# email pattern, phone pattern (three alternatives), and their replacement markers
EMAIL_PATTERN = r"[\w\.-]+@[\w\.-]+\.\w+"
PHONE_PATTERN = r"(?:\+?91[\s-]?)?[6-9]\d{4}[\s-]?\d{5}\b|\b\d{10}\b|\b\d{3}[-\s]\d{3}[-\s]\d{4}\b"
EMAIL_MARKER = "[EMAIL]"
PHONE_MARKER = "[PHONE]"
# --- end of fixed values ---

# Java regexes treat \w, \d and \b as ASCII unless UNICODE_CHARACTER_CLASS is
# on; Python's ``re`` is Unicode by default.  (?U) makes the JVM agree.
_U = "(?U)"
EMAIL_RE = _U + EMAIL_PATTERN
PHONE_RE = _U + PHONE_PATTERN
MARKER_RE = r"\[EMAIL\]|\[PHONE\]"

# Token rule shared by the lexicon operators: lower-case, split on anything
# that is not an ASCII letter.
TOKEN_SPLIT = "[^a-z]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a "let" binding).

    Catalyst inlines projected expressions into filters it pushes down, and
    a filter gets no common-subexpression elimination; an expensive value
    used several times would then run several times per row.  Binding it
    through a one-element array keeps it to one evaluation.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _guarded_replace(c: Column, guard, pattern: str, marker: str) -> Column:
    return let(c, lambda x: F.when(guard(x), F.regexp_replace(x, F.lit(pattern), F.lit(marker)))
               .otherwise(x))


def mask_emails(c) -> Column:
    # '@' is required by the pattern: skip the regex on rows without one.
    return _guarded_replace(_col(c), lambda x: F.instr(x, "@") > 0, EMAIL_RE, EMAIL_MARKER)


def mask_phones(c) -> Column:
    # Every alternative needs digits, of any script: skip rows without one.
    return _guarded_replace(_col(c), lambda x: x.rlike(_U + r"\d"), PHONE_RE, PHONE_MARKER)


def mask_pii(c) -> Column:
    """Emails first, then phones; NULL or empty input gives ''."""
    return F.coalesce(mask_phones(mask_emails(c)), F.lit(""))


def has_mask_marker(c) -> Column:
    """True when the text carries a mask marker; NULL text counts as False."""
    return F.coalesce(_col(c).rlike(MARKER_RE), F.lit(False))


def tokens(c) -> Column:
    """Distinct lower-case ASCII-letter tokens of a text."""
    return F.array_distinct(F.split(F.lower(_col(c)), TOKEN_SPLIT))


def check_regex(spark: SparkSession, pattern: str) -> str:
    """Validate a user search pattern before a job starts, with the engine
    that will run it.  Raises ``ValueError`` for a pattern that does not
    compile; Spark would otherwise fail inside a task."""
    try:
        spark.range(1).select(F.lit("").rlike(pattern).alias("x")).collect()
    except Exception as exc:
        raise ValueError(f"invalid search pattern {pattern!r}") from exc
    return pattern
