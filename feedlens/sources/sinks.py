"""Writers for the consolidated reviews and the report files (K1-K5).

All writers run as parallel Spark writes; only the theme CSV, which is one
row per theme, is written as a single file.  Text columns must be masked
before they reach a sink (see ``operators.privacy.clean_reviews``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import checkpoint_root
from feedlens.sources.readers import CSV_OPTIONS, NTZ_FORMAT

THEME_CSV_HEADER = ("Theme ID", "Theme Name", "Description")


def sink_reviews_json(df: DataFrame, path: str, partition_by: str | None = "source") -> None:
    """K1: labelled, masked reviews as JSON lines (overwrite), one folder
    per source so readers can prune by channel.  No shuffle before the
    write: every task writes its own file per source it holds, so a channel
    holding most rows is still written by all tasks."""
    w = df.write.mode("overwrite").option("timestampNTZFormat", NTZ_FORMAT)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def sink_themes_csv(themes: DataFrame, path: str) -> bool:
    """K2: the theme dimension as CSV, files of even size (one, as a rule), each with the header
    ``Theme ID,Theme Name,Description``; missing fields become ''.
    Returns False (and writes nothing) when there is no theme."""
    out = themes.select(
        F.coalesce(F.col("theme_id"), F.lit("")).alias(THEME_CSV_HEADER[0]),
        F.coalesce(F.col("name"), F.lit("")).alias(THEME_CSV_HEADER[1]),
        F.coalesce(F.col("description"), F.lit("")).alias(THEME_CSV_HEADER[2]))
    # Materialise once (a reliable checkpoint in the shared folder): the
    # test for emptiness and the write then read the same rows instead of
    # running the upstream plan twice.
    checkpoint_root(themes.sparkSession)
    out = out.checkpoint(eager=True)
    if out.isEmpty():
        return False
    (out.hint("rebalance").write.mode("overwrite").options(**CSV_OPTIONS)
     .option("emptyValue", "").csv(path))
    return True


def qa_json_lines(answers: DataFrame, key: str = "report_key") -> DataFrame:
    """One JSON object per report: ``{key, question_answers: {...}}`` with
    the answers in question order.  Input: key, q_order, question_key, answer."""
    entries = F.array_sort(F.collect_list(F.struct("q_order", "question_key", "answer")))
    amap = F.map_from_entries(F.transform(entries, lambda x: F.struct(x["question_key"], x["answer"])))
    return (answers.groupBy(key).agg(amap.alias("question_answers"))
            .select(key, F.to_json(F.struct(key, "question_answers")).alias("value")))


def sink_qa_json(answers: DataFrame, path: str, key: str = "report_key") -> bool:
    """K3: answers as JSON lines, one object per report (six entries at
    most per object).  Returns False when there is nothing to write."""
    checkpoint_root(answers.sparkSession)
    lines = qa_json_lines(answers, key).checkpoint(eager=True)
    if lines.isEmpty():
        return False
    lines.select("value").write.mode("overwrite").text(path)
    return True


def sink_notes_text(notes: DataFrame, path: str, keys=("source", "week_label")) -> None:
    """K4: each note as its own text file under ``source=.../week_label=...``
    (one note per partition folder, so a whole-text read returns it intact)."""
    keys = list(keys)
    (notes.repartition(*keys).select(*keys, F.col("note").alias("value"))
     .write.mode("overwrite").partitionBy(*keys).text(path))


def sink_filtered_csv(df: DataFrame, path: str) -> None:
    """K5: the filtered reviews with all their columns as UTF-8 CSV with a
    header and no index column; quotes are doubled, not backslashed."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)

