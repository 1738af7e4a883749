"""Readers for landing data and report files.

Every reader declares its schema; nothing is inferred.  JSON lines and CSV
are splittable, so a folder of any size is read by many tasks; a JSON
*array* file (the format of a hand-made dump) is read whole per file with
``multiLine``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.dates import parse_date
from feedlens.functions.lexicon import QUESTIONS
from feedlens.schemas import FEED_ENTRY, PLAYSTORE, REVIEW_RAW, THEMES_CSV

NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Spark's CSV writer trims values by default and escapes quotes with a
# backslash; keep values whole and double the quotes as CSV readers expect.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "timestampNTZFormat": NTZ_FORMAT}
NA = "N/A"


RATING_MIN, RATING_MAX = 1, 5


def coerce_rating(c) -> "F.Column":
    """Numeric coercion.  Decimal text counts as its number (``4.0`` is
    4), a part of a star goes to the nearer whole one (halves up); what is not
    a number, or lies outside 1..5, becomes NULL (``try_cast``: a plain cast
    fails the task under ANSI mode)."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.try_cast("double")
    return F.when(v.between(RATING_MIN, RATING_MAX), F.floor(v + F.lit(0.5)).cast("int"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` (a file, folder or glob) matches anything, asked of
    the file system that holds it (local, HDFS or an object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


CORRUPT = "_corrupt"
#: Reasons of rejects.
NOT_JSON, NO_DATE, NO_LIST, NO_ENTRY = "not JSON", "no ISO date", "entry is no list", "not an entry"


def _raw_reviews(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """The dump as string-typed rows and, for a record that is not JSON, its
    text in ``_corrupt``; a missing dump reads as no rows."""
    schema = T.StructType([*REVIEW_RAW.fields, T.StructField(CORRUPT, T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("multiLine", str(multi_line).lower())
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def scan_reviews_json(spark: SparkSession, path: str, *, multi_line: bool) -> DataFrame:
    """Reviews from a JSON dump: JSON lines, or with ``multi_line`` files
    that hold one array.  Ids are strings (null for none), ratings are coerced,
    dates parsed.  Every record is either here or, if it is not JSON or its date
    does not parse, in ``scan_reviews_json_rejects``.  A missing dump gives
    no rows.  ``identity.with_review_key`` gives each row a key of its own.
    """
    raw = _raw_reviews(spark, path, multi_line)
    return normalize_raw(raw.where(_raw_reject().isNull()).drop(CORRUPT))


def _raw_reject():
    """Why a record of a dump is rejected; null if it is not."""
    return F.when(F.col(CORRUPT).isNotNull(), NOT_JSON).when(parse_date("date").isNull(), NO_DATE)


def scan_reviews_json_rejects(spark: SparkSession, path: str, *, multi_line: bool) -> DataFrame:
    """``reason, record``: every record that ``scan_reviews_json`` leaves out,
    as it came (the text, or the row as JSON)."""
    raw = _raw_reviews(spark, path, multi_line)
    reason = _raw_reject()
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*REVIEW_RAW.fieldNames())))
    return raw.select(reason.alias("reason"), record.alias("record")).where("reason is not null")


def normalize_reviews(play: DataFrame | None = None, app: DataFrame | None = None,
                      social: DataFrame | None = None) -> DataFrame:
    """Bring every landing shape to the canonical review columns and
    union them (bag semantics).  ``review_id`` is the channel's own, a string.

    play:   store export records ``review_id, score, content, at``
    app:    feed page bodies ``page, body``
    social: string-typed dump rows (``REVIEW_RAW``)

    Ratings are coerced in every shape, and rows without a date that parses
    stay out (the readers' reject outputs hold them).
    """
    cols = ["review_id", "source", "rating", "title", "text", "date"]
    parts = []
    if play is not None:
        parts.append(normalize_playstore(play))
    if app is not None:
        parts.append(scan_appstore_feed(app).select(*cols))
    if social is not None:
        parts.append(normalize_raw(social).select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("date").isNotNull())


def normalize_raw(raw: DataFrame) -> DataFrame:
    """P1 for string-typed landing rows: the canonical six columns."""
    return raw.select(
        F.col("review_id").cast("string").alias("review_id"),
        F.col("source"),
        coerce_rating("rating").alias("rating"),
        F.col("title"),
        F.col("text"),
        parse_date("date").alias("date"),
    )


def normalize_playstore(records: DataFrame) -> DataFrame:
    """P1 for store export records: no title, source 'playstore'; the naive
    time is read as UTC."""
    return records.select(F.col("review_id").cast("string").alias("review_id"), F.lit("playstore").alias("source"),
                          coerce_rating("score").alias("rating"), F.lit(None).cast("string").alias("title"),
                          F.col("content").alias("text"), F.col("at").alias("date"))


def feed_entries(pages: DataFrame, body_col: str = "body", keep=("page",)) -> DataFrame:
    """``keep, position, record, reason, e``: every entry of the feed pages (one
    JSON body per row) as it came, with its place on the page from 0, why it is
    rejected (null if it is not), and its fields.

    ``feed.entry`` may be a list or a single object.  A page that is not JSON,
    or whose ``feed.entry`` is neither, is one row without a position; a page
    without entries gives none."""
    body = F.col(body_col)
    listed = F.get_json_object(body, "$.feed.entry")
    listed = F.when(listed.startswith("{"), F.concat(F.lit("["), listed, F.lit("]"))).otherwise(listed)
    read = pages.select(*keep, body.alias("_body"), listed.alias("_listed"))
    read = read.withColumn("_entries", F.from_json("_listed", T.ArrayType(T.StringType())))
    page_reason = (F.when(F.col("_entries").isNotNull(), None).when(F.col("_listed").isNotNull(), NO_LIST)
                   .when(F.try_parse_json("_body").isNull(), NOT_JSON))
    rows = read.select(*keep, "_body", page_reason.alias("_page_reason"), F.posexplode_outer("_entries").alias("position", "_raw"))
    rows = rows.where(F.col("position").isNotNull() | F.col("_page_reason").isNotNull())
    entry = F.from_json("_raw", FEED_ENTRY)
    rows = rows.select(*keep, "position", F.coalesce("_raw", F.when(F.col("_page_reason").isNotNull(), F.col("_body"))).alias("record"),
                       "_page_reason", F.when(F.col("_raw").startswith("{"), entry).alias("e"))
    reason = (F.when(F.col("_page_reason").isNotNull(), F.col("_page_reason")).when(F.col("e").isNull(), NO_ENTRY)
              .when(parse_date(F.col("e.updated.label")).isNull(), NO_DATE))
    return rows.select(*keep, "position", "record", reason.alias("reason"), "e")


def scan_appstore_feed(pages: DataFrame, body_col: str = "body", keep=("page",)) -> DataFrame:
    """The reviews of app-store feed pages (see ``feed_entries``).

    Ratings are coerced (a missing one is NULL), title and text default to
    ''.  An entry without a date that parses is in ``scan_appstore_feed_rejects``
    instead; kept and rejected entries together are all entries."""
    good = feed_entries(pages, body_col, keep).where(F.col("reason").isNull())
    return good.select(
        F.col("e.id.label").alias("review_id"),
        *keep,
        F.lit("appstore").alias("source"),
        coerce_rating(F.col("e.`im:rating`.label")).alias("rating"),
        F.coalesce(F.col("e.title.label"), F.lit("")).alias("title"),
        F.coalesce(F.col("e.content.label"), F.lit("")).alias("text"),
        parse_date(F.col("e.updated.label")).alias("date"),
    )


def scan_appstore_feed_rejects(pages: DataFrame, body_col: str = "body", keep=("page",)) -> DataFrame:
    """``keep, position, reason, record``: the entries, and the pages without
    a readable list of entries, that ``scan_appstore_feed`` leaves out."""
    bad = feed_entries(pages, body_col, keep).where(F.col("reason").isNotNull())
    return bad.select(*keep, "position", "reason", "record")


def scan_playstore(spark: SparkSession, path: str) -> DataFrame:
    """S3: store export records ``{review_id, score, content, at}`` to reviews."""
    return normalize_playstore(spark.read.schema(PLAYSTORE).parquet(path))


LABELLED = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("theme", T.StringType()),
])


def scan_labelled_reviews(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Reload labelled reviews for the dashboard: fixed schema, rating
    coerced (bad -> NULL), missing theme -> the fallback name."""
    from feedlens.operators.search import default_theme
    reader = spark.read.schema(LABELLED)
    if fmt == "json":
        df = reader.option("timestampNTZFormat", NTZ_FORMAT).json(path)
    else:
        df = reader.format(fmt).load(path)
    df = df.withColumn("rating", coerce_rating("rating"))
    return default_theme(df)


def scan_themes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The theme dimension from its CSV export."""
    df = spark.read.schema(THEMES_CSV).options(**CSV_OPTIONS).csv(path)
    return df.select(F.col("Theme ID").alias("theme_id"), F.col("Theme Name").alias("name"),
                     F.col("Description").alias("description"))


REPLY_LINE = "source string, batch long, response string, _corrupt string"


def scan_replies(spark: SparkSession, path: str) -> DataFrame:
    """Model replies as they land, JSON lines ``source, batch, response``.

    A line that is not JSON has no batch to belong to; it comes with null keys
    and its text as the response, so that the parser rejects or recovers it
    like any other.  A missing folder gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REPLY_LINE).drop(CORRUPT)
    raw = spark.read.schema(REPLY_LINE).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return raw.select("source", "batch", F.coalesce(F.col(CORRUPT), F.col("response")).alias("response"))


def scan_qa_json(spark: SparkSession, path: str, key: str = "report_key") -> DataFrame:
    """Question answers per report; every one of the six questions is
    present, an unanswered one reads 'N/A'."""
    schema = T.StructType([T.StructField(key, T.StringType()),
                           T.StructField("question_answers", T.MapType(T.StringType(), T.StringType()))])
    df = spark.read.schema(schema).json(path)
    arr = F.array(*[F.struct(F.lit(i + 1).alias("q_order"), F.lit(k).alias("question_key"))
                    for i, (k, _) in enumerate(QUESTIONS)])
    return df.select(key, F.inline(arr), "question_answers").select(
        key, "q_order", "question_key",
        F.coalesce(F.try_element_at("question_answers", F.col("question_key")), F.lit(NA)).alias("answer"))
