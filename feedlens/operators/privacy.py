"""Contact masking operators.

Masking is a narrow projection: it runs map-side in the scan stage and never
shuffles.  It is applied before any sink or metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.text import (EMAIL_RE, MARKER_RE, PHONE_RE, has_mask_marker, let,
                                     mask_emails, mask_phones, mask_pii)

UNKNOWN_SOURCE = "unknown"


def mask_columns(df: DataFrame, cols, suffix: str | None = None) -> DataFrame:
    """Replace (or add ``<col><suffix>``) masked versions of text columns."""
    out = df
    for c in cols:
        out = out.withColumn(c if suffix is None else f"{c}{suffix}", mask_pii(c))
    return out


def clean_reviews(df: DataFrame) -> DataFrame:
    """Whitelist the review columns and mask text and title.

    ``source`` defaults to 'unknown'; text becomes masked or ''; a NULL or
    empty title stays NULL, any other title is masked.  Every other column
    of the input is dropped so no stray field carries personal data.
    """
    cols = set(df.columns)
    keep = [F.col("review_id")] if "review_id" in cols else []
    return df.select(
        *keep,
        F.coalesce(F.col("source"), F.lit(UNKNOWN_SOURCE)).alias("source"),
        F.col("rating"),
        F.when(F.length("title") > 0, mask_pii("title")).alias("title"),
        mask_pii("text").alias("text"),
        F.col("date"),
    )


def pii_marked_rows(df: DataFrame, col: str = "text") -> DataFrame:
    """rows whose (masked) text carries an [EMAIL] or [PHONE] marker."""
    return df.where(has_mask_marker(col))


def pii_incident_counts(df: DataFrame, by: str = "source", col: str = "text") -> DataFrame:
    """Per group, rows, rows changed by masking, and occurrences by kind.

    Occurrences are counted on the raw text with the same patterns and the
    same order as the masking (emails first, phones on the email-masked
    text), so they equal the number of markers inserted.
    """
    raw = F.coalesce(F.col(col), F.lit(""))
    email_n = F.when(F.instr(raw, "@") > 0, F.regexp_count(raw, F.lit(EMAIL_RE))).otherwise(0)
    # The email-masked text is bound once: the phone count and the fully
    # masked text (equal to ``mask_pii``, NULL input included) both come
    # from it, and the masked text is bound once for both flags.
    step = let(mask_emails(raw), lambda e: F.struct(
        F.regexp_count(e, F.lit(PHONE_RE)).alias("p"),
        let(mask_phones(e), lambda m: F.struct((m != raw).alias("changed"),
                                                m.rlike(MARKER_RE).alias("marked"))).alias("m")))
    return (df.select(F.col(by), email_n.alias("_e"), step.alias("_s"))
            .select(by, "_e", F.col("_s.p").alias("_p"), F.col("_s.m.changed").alias("_changed"),
                    F.col("_s.m.marked").alias("_marked"))
            .groupBy(by)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if("_changed").alias("masked_rows"),
                 F.count_if("_marked").alias("marked_rows"),
                 F.sum("_e").cast("bigint").alias("email_hits"),
                 F.sum("_p").cast("bigint").alias("phone_hits")))
