"""Incremental ingestion with Structured Streaming.

The batch operators re-run over a landing folder as new dump files arrive:
rows are normalised, masked and themed exactly as in batch, duplicates of a
review inside the window are dropped with a watermark, and the labelled
rows are appended to a partitioned table.  The checkpoint (offsets and
dedupe state) lives in a folder that the caller names, so a restarted query
resumes where it stopped and a lost executor only replays its micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlens.operators.ingest import DEFAULT_WEEKS
from feedlens.operators.privacy import clean_reviews
from feedlens.operators.themes import assign_themes
from feedlens.schemas import REVIEW_RAW
from feedlens.sources.identity import base_key
from feedlens.sources.readers import normalize_raw


def review_stream(spark: SparkSession, landing_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines dump files arriving in ``landing_dir`` as canonical rows;
    rows whose date does not parse are dropped (as in batch)."""
    reader = spark.readStream.schema(REVIEW_RAW)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return normalize_raw(reader.json(landing_dir)).where(F.col("date").isNotNull())


def labelled_stream(stream: DataFrame, lexicon: dict, names: dict, weeks: int = DEFAULT_WEEKS) -> DataFrame:
    """Mask, theme (with a small dict, inside the row) and de-duplicate a review stream.

    The watermark is the rolling window: a copy of a review arriving
    within ``weeks`` of event time is dropped; state older than that is
    evicted, so the dedupe state stays bounded."""
    labelled = assign_themes(clean_reviews(stream), lexicon, names)
    return (labelled.withColumn("event_time", F.col("date").cast("timestamp"))
            .withWatermark("event_time", f"{7 * int(weeks)} days")
            .withColumn("review_key", base_key())
            .dropDuplicatesWithinWatermark(["review_key"]).drop("review_key"))


def weekly_theme_counts(labelled: DataFrame) -> DataFrame:
    """Reviews per (week, source, theme); weeks start on Monday."""
    week = F.window("event_time", "7 days", "7 days", "4 days")
    return (labelled.groupBy(week.alias("week"), "source", "theme_id")
            .agg(F.count(F.lit(1)).alias("n_reviews"))
            .select(F.col("week.start").alias("week_start"), "source", "theme_id", "n_reviews"))


def start_labelled_sink(labelled: DataFrame, out_dir: str, checkpoint_dir: str,
                        available_now: bool = True) -> StreamingQuery:
    """Append labelled rows to ``out_dir`` (parquet, one folder per source).
    A query started again with the same ``checkpoint_dir`` goes on where it
    stopped and appends nothing twice."""
    writer = (labelled.drop("event_time").writeStream.format("parquet")
              .option("checkpointLocation", checkpoint_dir).partitionBy("source").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)
