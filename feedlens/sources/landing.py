"""Landing layout by channel and week.

Landed rows lie in one folder per channel and week, so a window reads the
folders that overlap it and no other file, and a channel reads only its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.dates import week_start, window_start
from feedlens.operators.ingest import DEFAULT_WEEKS, feed_take_while
from feedlens.sources.readers import path_exists

LAYOUT = ("source", "week")
WEEK_FORMAT = "yyyy-MM-dd"


def _week(date: Column) -> Column:
    """Monday of the row's week, as a date; null without a date."""
    return week_start(date).cast("date")


def land(df: DataFrame, path: str, replace_weeks: bool = False) -> None:
    """Add ``df(source, date, ...)`` to the landing folder, one folder per
    channel and week; rows without a date or channel lie in a folder of their own.

    The rows are dealt evenly by channel and week (a rebalance, which Spark splits
    where one channel or week holds most rows), so a folder gets few files and
    no task writes to many.  With ``replace_weeks`` the (channel, week) folders that
    occur in ``df`` are replaced, so that landing a crawl again adds nothing twice;
    the others stay."""
    writer = (df.withColumn("week", _week(F.col("date"))).hint("rebalance", *LAYOUT).write
              .partitionBy(*LAYOUT).mode("overwrite" if replace_weeks else "append"))
    if replace_weeks:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def scan_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed rows in the columns of ``schema`` (that of the landed rows); a
    missing folder gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    read = spark.read.schema(T.StructType([*fields, T.StructField("week", T.DateType())])).parquet(path)
    return read.select(*schema.fieldNames(), "week")


def scan_window(spark: SparkSession, path: str, schema: T.StructType, as_of, weeks: int = DEFAULT_WEEKS,
                sources: tuple | None = None) -> DataFrame:
    """F1 over the landing folder: rows with ``date >= as_of - weeks``, of the
    given channels or all.  The bound's own week and all later ones are read,
    and no file of an earlier week."""
    rows = scan_landing(spark, path, schema)
    if "week" not in rows.columns:
        return rows
    start = window_start(as_of, weeks)
    rows = rows.where((F.col("week") >= _week(start)) & (F.col("date") >= start))
    if sources is not None:
        rows = rows.where(F.col("source").isin(*sources))
    return rows.drop("week")


def feed_in_window(spark: SparkSession, path: str, schema: T.StructType, as_of, weeks: int = DEFAULT_WEEKS,
                   source: str = "appstore", by: tuple = ()) -> DataFrame:
    """W1 over the landing folder of feed rows (``schema`` with ``page``): a
    page counts by its rows in the window alone, so only the window's folders are read."""
    rows = scan_window(spark, path, schema, as_of, weeks, (source,))
    return feed_take_while(rows, as_of, weeks, by)
