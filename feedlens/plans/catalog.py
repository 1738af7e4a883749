"""The registered queries: one builder per operator key of the inventory.

Each builder takes ``(spark, sf_dir)``, reads the bundled tables (whole
tables, every row) and returns a lazy DataFrame.  Where a query needs the
window end, it is the newest review date, fetched by one tiny aggregate and
then used as a literal so the window filter reaches the parquet scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.dates import iso_string, parse_date
from feedlens.operators import ingest, metrics, privacy, prompts, replies, reports, search, themes
from feedlens.plans.params import (CONTEXT_CHARS, CUT_REPLY, FAIR_K, FEED_PAGE_SIZE, FENCED_REPLY, HEAD_SIZE, NEWEST_N,
                                   PACK_SIZE, QUESTION_TERMS, QUOTE_K, REFUSAL, REFUSED_REPLY, REPLY_CYCLE, RESAMPLE_RATE, RESAMPLE_SEED,
                                   SEARCH_PATTERN, STRAY_EVERY, THEME_NAMES, THEME_TERMS, TOP_K, WEEKS)
from feedlens.operators.ordering import number_within
from feedlens.operators.search_index import SearchIndex
from feedlens.session import ensure_utc, scratch_path
from feedlens.sources import identity, landing, readers, sinks, tables

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        REGISTRY[key] = fn
        return fn
    return deco


def _reviews(spark: SparkSession, sf: str) -> DataFrame:
    ensure_utc(spark)
    return tables.reviews(spark, sf)


def _asof(reviews: DataFrame):
    return tables.latest_date(reviews)


def _clean(spark, sf) -> DataFrame:
    return privacy.clean_reviews(_reviews(spark, sf))


def _themed(spark, sf) -> DataFrame:
    return themes.assign_themes(_clean(spark, sf), THEME_TERMS, THEME_NAMES)


# ---------------------------------------------------------------- privacy

@register("mask_pii")
def q_mask_pii(spark, sf):
    docs = tables.table(spark, sf, "documents").select(
        F.lit("documents").alias("corpus"), F.col("doc_id").alias("id"),
        F.lit(0).cast("bigint").alias("part"), F.col("text"))
    pages = tables.table(spark, sf, "pages").select(
        F.lit("pages").alias("corpus"), F.col("page_id").alias("id"),
        F.lit(0).cast("bigint").alias("part"), F.col("html").alias("text"))
    convs = tables.table(spark, sf, "conversations").select(
        F.lit("conversations").alias("corpus"), F.col("conv_id").alias("id"),
        F.col("turn").alias("part"), F.col("text"))
    allt = docs.unionByName(pages).unionByName(convs)
    return privacy.mask_columns(allt, ["text"]).withColumnRenamed("text", "masked")


@register("clean_reviews")
def q_clean_reviews(spark, sf):
    return _clean(spark, sf)


@register("pii_marked_rows")
def q_pii_marked_rows(spark, sf):
    return privacy.pii_marked_rows(_clean(spark, sf)).select("review_id", "source", "text")


@register("pii_incident_counts")
def q_pii_incident_counts(spark, sf):
    return privacy.pii_incident_counts(_reviews(spark, sf))


# ---------------------------------------------------------------- ingestion

@register("rolling_window_filter")
def q_rolling_window_filter(spark, sf):
    r = _reviews(spark, sf)
    return ingest.rolling_window(r, _asof(r), WEEKS)


def _dump(spark, sf) -> DataFrame:
    """The social dump as it lands: dates are strings.  One channel exports
    human-readable dates, which the ISO parser rejects."""
    r = _reviews(spark, sf)
    raw = F.when(F.col("source") == "linkedin", F.date_format("date", "MMMM dd, yyyy")) \
        .otherwise(iso_string("date"))
    return r.select("review_id", "source", "rating", "title", "text", raw.alias("date_raw"))


@register("drop_unparseable_dates")
def q_drop_unparseable_dates(spark, sf):
    kept, rejected = ingest.split_on_dates(_dump(spark, sf))
    cols = ["review_id", "source", "date_raw", "date"]
    return (kept.select(*cols, F.lit("kept").alias("status"))
            .unionByName(rejected.select(*cols, F.lit("rejected").alias("status"))))


@register("source_window_counts")
def q_source_window_counts(spark, sf):
    r = _reviews(spark, sf)
    as_of = _asof(r)
    parsed = _dump(spark, sf).withColumn("date", parse_date("date_raw"))
    return ingest.source_window_counts(parsed, as_of, WEEKS)


@register("feed_take_while")
def q_feed_take_while(spark, sf):
    r = _reviews(spark, sf)
    return ingest.feed_take_while(tables.appstore_feed(r, FEED_PAGE_SIZE, STRAY_EVERY), _asof(r), WEEKS)


@register("landing_window")
def q_landing_window(spark, sf):
    r = _reviews(spark, sf)
    path = scratch_path(spark, "landing")
    landing.land(r, path)
    return landing.scan_window(spark, path, r.schema, _asof(r), WEEKS)


@register("landing_feed")
def q_landing_feed(spark, sf):
    r = _reviews(spark, sf)
    feed = tables.appstore_feed(r, FEED_PAGE_SIZE, STRAY_EVERY).withColumn("source", F.lit("appstore"))
    path = scratch_path(spark, "landing-feed")
    landing.land(feed, path)
    return landing.feed_in_window(spark, path, feed.schema, _asof(r), WEEKS).drop("source")


@register("newest_n")
def q_newest_n(spark, sf):
    r = _reviews(spark, sf)
    newest = ingest.newest_n(r.where(F.col("source") == "playstore"), NEWEST_N)
    return ingest.rolling_window(newest, _asof(r), WEEKS)


def _tagged(spark, sf):
    """Crawl and dump rows in the window, from one read of the view: the two
    stores are crawled whole, and the dump holds every channel."""
    r = _reviews(spark, sf)
    rows = ingest.rolling_window(r, _asof(r), WEEKS)
    both = F.when(F.col("source").isin("playstore", "appstore"), F.array(F.lit(True), F.lit(False)))
    return rows.withColumn("crawled", F.explode(F.coalesce(both, F.array(F.lit(False)))))


@register("source_precedence")
def q_source_precedence(spark, sf):
    tagged = _tagged(spark, sf)
    return ingest.source_precedence(tagged.where("crawled"), tagged.where("not crawled")).drop("crawled")


def _union(spark, sf):
    return ingest.consolidate(_tagged(spark, sf)).drop("crawled")


@register("union_sources")
def q_union_sources(spark, sf):
    return _union(spark, sf)


@register("topup_resample")
def q_topup_resample(spark, sf):
    r = _reviews(spark, sf)
    return ingest.resample(ingest.rolling_window(r, _asof(r), WEEKS), RESAMPLE_RATE, RESAMPLE_SEED)


# ---------------------------------------------------------------- metrics

@register("dashboard_kpis")
def q_dashboard_kpis(spark, sf):
    return metrics.dashboard_kpis(_clean(spark, sf))


@register("channel_share")
def q_channel_share(spark, sf):
    return metrics.channel_share(_reviews(spark, sf))


@register("ratings_distribution")
def q_ratings_distribution(spark, sf):
    return metrics.ratings_distribution(_reviews(spark, sf))


@register("rated_only")
def q_rated_only(spark, sf):
    return metrics.rated_only(_reviews(spark, sf)).select("review_id", "source", "rating")


@register("facet_values")
def q_facet_values(spark, sf):
    return metrics.facet_values(_themed(spark, sf))


# ---------------------------------------------------------------- search

@register("facet_filter")
def q_facet_filter(spark, sf):
    out = search.facet_filter(_themed(spark, sf), source="appstore", rating=4,
                              theme="English-language feedback")
    return out.select("review_id", "source", "rating", "theme", "title", "text", "date")


@register("search_reviews")
def q_search_reviews(spark, sf):
    return search.search_reviews(_clean(spark, sf), SEARCH_PATTERN).select(
        "review_id", "source", "title", "text")


@register("search_indexed")
def q_search_indexed(spark, sf):
    rows = _clean(spark, sf).select("review_id", "source", "title", "text")
    # Few folders: the bundled tables are small.
    index = SearchIndex(spark, scratch_path(spark, "search-index"), rows.schema, gram_folders=8, row_folders=8).build(rows)
    return index.search(SEARCH_PATTERN)


@register("default_theme")
def q_default_theme(spark, sf):
    # The theme name as a lookup gives it: NULL for a review without any
    # lexicon term; the default fills those.  One pass over the text.
    return search.default_theme(themes.theme_names_or_null(_clean(spark, sf), THEME_TERMS, THEME_NAMES)
                                .select("review_id", "theme"))


@register("display_projection")
def q_display_projection(spark, sf):
    return search.display_projection(_themed(spark, sf))


@register("preview_lines")
def q_preview_lines(spark, sf):
    return search.preview_lines(_clean(spark, sf))


# ---------------------------------------------------------------- themes

@register("theme_lexicon_join")
def q_theme_lexicon_join(spark, sf):
    return themes.theme_lexicon_join(_clean(spark, sf), THEME_TERMS)


@register("question_evidence_join")
def q_question_evidence_join(spark, sf):
    return themes.question_evidence_join(_clean(spark, sf), QUESTION_TERMS)


@register("assign_themes")
def q_assign_themes(spark, sf):
    return _themed(spark, sf).select("review_id", "source", "theme_id", "theme", "theme_score")


@register("theme_volume_severity")
def q_theme_volume_severity(spark, sf):
    return themes.theme_volume_severity(_themed(spark, sf))


@register("top_themes")
def q_top_themes(spark, sf):
    return themes.top_themes(_themed(spark, sf), TOP_K, by=("source",))


@register("representative_quotes")
def q_representative_quotes(spark, sf):
    return themes.representative_quotes(_themed(spark, sf), by=("source",))


@register("question_evidence")
def q_question_evidence(spark, sf):
    return themes.question_evidence(_clean(spark, sf), QUESTION_TERMS, QUOTE_K)


# ---------------------------------------------------------------- flagship

def channel_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Per channel: reviews, share of all reviews, mean rating (2 dp) and
    rows whose masked text carries a marker.  Scan -> join -> masking
    projection -> one partial/final hash aggregate -> a window over the
    five aggregated rows."""
    from pyspark.sql import Window
    from feedlens.functions.text import has_mask_marker
    clean = _clean(spark, sf)
    per = (clean.groupBy("source")
           .agg(F.count(F.lit(1)).alias("n_reviews"),
                F.round(F.avg("rating"), 2).alias("avg_rating"),
                F.count_if(has_mask_marker("text")).alias("masked_rows")))
    return per.withColumn("share", F.col("n_reviews") / F.sum("n_reviews").over(Window.partitionBy()))


# ---------------------------------------------------------------- prompts

def _batched(spark, sf) -> DataFrame:
    """Place of every review in the prompts: narrow rows, no text."""
    return prompts.assign_batches(prompts.number_reviews(_clean(spark, sf)))


def _reply_texts(spark, sf, readable: bool = False) -> DataFrame:
    """``source, batch, response``: what the reviews of a batch are answered with,
    put together from their themes; by its number a batch's reply comes
    inside a code fence, cut off, or as a refusal, as models send them.  With
    ``readable`` none is cut off or refused, as after asking again."""
    from feedlens.functions.lexicon import FALLBACK_THEME_ID, QUESTIONS
    keys = ["source", "batch"]
    themed = themes.assign_themes(_clean(spark, sf), THEME_TERMS, THEME_NAMES, questions=QUESTION_TERMS)
    place = _batched(spark, sf).select(F.col("review_id").alias("_id"), "batch", "review_index")
    rows = themed.join(place, themed["review_id"] == place["_id"])
    per_theme = rows.groupBy(*keys, "theme_id", "theme").agg(
        F.count("*").alias("n"), F.min_by("text", "review_index").alias("quote"),
        F.collect_list(F.struct("review_index", "theme_id")).alias("assigned"),
        *(F.count_if(F.array_contains(F.transform("q_scores", lambda x: x["question_key"]), q)).alias(q) for q, _ in QUESTIONS))
    described = F.create_map(*(x for k, v in sorted(THEME_NAMES.items()) for x in (F.lit(k), F.lit(v[1]))))
    theme = F.when(F.col("theme_id") != FALLBACK_THEME_ID, F.struct(
        F.col("theme_id").alias("id"), F.col("theme").alias("name"), described[F.col("theme_id")].alias("description")))
    # A batch has as many rows as a prompt at most, so its lists are short.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "theme_id", "theme", "quote")))
    batch = per_theme.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.array_sort(F.collect_list(theme)).alias("themes"),
        F.array_sort(F.flatten(F.collect_list("assigned"))).alias("clustering"), F.slice(ranked, 1, 3).alias("top"),
        *(F.sum(q).alias(q) for q, _ in QUESTIONS))
    total = F.col("n").cast("string")
    answers = F.create_map(*(x for q, _ in QUESTIONS for x in (
        F.lit(q), F.concat(F.col(q).cast("string"), F.lit(" of "), total, F.lit(" reviews")))))
    note = F.struct(
        F.transform("top", lambda t, i: F.struct(
            (i + 1).alias("rank"), t["theme"].alias("name"),
            F.concat((-t["neg"]).cast("string"), F.lit(" of "), total, F.lit(" reviews")).alias("rationale"))).alias("top_themes"),
        F.transform("top", lambda t: t["quote"]).alias("user_quotes"),
        F.transform("top", lambda t: F.concat(F.lit("Review the "), t["theme"], F.lit(" feedback"))).alias("action_ideas"))
    reply = F.to_json(F.struct("themes", "clustering", answers.alias("question_answers"), note.alias("weekly_note")))
    sent = batch.select(*keys, reply.alias("reply"))
    fenced = F.concat(F.lit("Here is the analysis:\n```json\n"), "reply", F.lit("\n```\nAnything else?"))
    cut = F.substring("reply", F.lit(1), F.floor(F.length("reply") / 2).cast("int"))
    place = F.col("batch") % REPLY_CYCLE
    faulty = F.lit(not readable)
    return sent.select(*keys, F.when(place == FENCED_REPLY, fenced)
                       .when(faulty & (place == REFUSED_REPLY), F.lit(REFUSAL))
                       .when(faulty & (place == CUT_REPLY), cut).otherwise(F.col("reply")).alias("response"))


def _parsed(spark, sf, readable: bool = False) -> DataFrame:
    """The replies as they land (JSON lines), read and parsed."""
    path = scratch_path(spark, "replies")
    _reply_texts(spark, sf, readable).write.json(path)
    return replies.parse_responses(readers.scan_replies(spark, path))


@register("number_reviews")
def q_number_reviews(spark, sf):
    return prompts.number_reviews(_clean(spark, sf))


@register("prompt_lines")
def q_prompt_lines(spark, sf):
    return prompts.prompt_lines(_clean(spark, sf))


@register("pack_prompts")
def q_pack_prompts(spark, sf):
    return prompts.pack_prompts(_clean(spark, sf), PACK_SIZE)


def measure_prompt(prompt: str) -> str:
    """A provider's size limit: the prompt's length, or an error beyond ``CONTEXT_CHARS``."""
    if len(prompt) > CONTEXT_CHARS:
        raise ValueError(f"{len(prompt)} characters are more than {CONTEXT_CHARS}")
    return f'{{"characters": {len(prompt)}}}'


@register("annotate_batches")
def q_annotate_batches(spark, sf):
    store = replies.ReplyStore(spark, scratch_path(spark, "reply-store"))
    return replies.annotate_batches(prompts.pack_prompts(_clean(spark, sf), PACK_SIZE), measure_prompt, store)


@register("subsample_head")
def q_subsample_head(spark, sf):
    return prompts.subsample(_union(spark, sf), HEAD_SIZE, FAIR_K).select(
        "variant", "review_id", "source", "priority", "rank")


@register("preview_head")
def q_preview_head(spark, sf):
    return prompts.preview_head(_reviews(spark, sf))


@register("parse_responses")
def q_parse_responses(spark, sf):
    return _parsed(spark, sf).select("source", "batch", "status",
                                     F.size(F.col("payload.themes")).cast("bigint").alias("n_themes"),
                                     F.size(F.col("payload.clustering")).cast("bigint").alias("n_assignments"))


@register("reply_quarantine")
def q_reply_quarantine(spark, sf):
    return replies.quarantine(_parsed(spark, sf)).select(
        "source", "batch", "reason", F.substring("response", 1, 10).alias("starts_with"))


@register("explode_payload")
def q_explode_payload(spark, sf):
    # Every batch's payload: those of refused and cut replies, too.
    return prompts.payload_rows(prompts.explode_payload(_parsed(spark, sf, readable=True)))


@register("theme_back_join")
def q_theme_back_join(spark, sf):
    parts = prompts.explode_payload(_parsed(spark, sf))
    pos = _batched(spark, sf).select("source", "batch", "review_index", "review_id")
    return themes.theme_back_join(pos, parts["assignments"], parts["themes"])


# ---------------------------------------------------------------- reports

def _notes(spark, sf) -> DataFrame:
    return reports.weekly_note(themes.assign_themes(_clean(spark, sf), THEME_TERMS, THEME_NAMES, questions=QUESTION_TERMS), TOP_K)


@register("weekly_note")
def q_weekly_note(spark, sf):
    return _notes(spark, sf)


@register("parse_action_items")
def q_parse_action_items(spark, sf):
    return reports.parse_action_items(_notes(spark, sf))


@register("first_wins_dedupe")
def q_first_wins_dedupe(spark, sf):
    items = reports.parse_action_items(_notes(spark, sf))
    return reports.first_wins_dedupe(items, "item", ["report_key", "item_no"],
                                     add=list(reports.FALLBACK_ACTIONS))


# ---------------------------------------------------------------- sources and sinks


@register("scan_reviews_json")
def q_scan_reviews_json(spark, sf):
    path = scratch_path(spark, "reviews-json")
    dump = _dump(spark, sf).select(F.col("review_id").cast("string").alias("review_id"), "source", F.col("rating").cast("string").alias("rating"),
                                   "title", "text", F.col("date_raw").alias("date"))
    dump.write.mode("overwrite").json(path)
    return readers.scan_reviews_json(spark, path, multi_line=False)


@register("review_identity")
def q_review_identity(spark, sf):
    """Dump rows with the ids that channels give (a prefix and a number, a
    number, or none); rows with the best rating landed twice."""
    number = F.col("review_id").cast("string")
    native = F.when(F.col("source") == "reddit", F.concat(F.lit("t3_"), number)).when(F.col("source") == "appstore", number)
    twice = F.when(F.col("rating") == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = _dump(spark, sf).withColumn("copy", F.explode(twice)).select(
        native.alias("review_id"), "source", F.col("date_raw").alias("date"), "title", "text")
    return identity.with_review_key(rows, keep=("review_id", "source")).select("review_key", "review_id", "source")


def _feed_pages(spark, sf, faulty: bool = False) -> DataFrame:
    """App-store rows as the feed serves them: pages of 50 entries, newest
    first, each page one JSON body; with ``faulty`` entries of the worst rating
    have a date that is not ISO."""
    app = _reviews(spark, sf).where(F.col("source") == "appstore")
    numbered = number_within(app, [], [F.col("date").desc(), F.col("review_id")], name="rn")
    updated = iso_string("date")
    if faulty:
        updated = F.when(F.col("rating") == 1, F.date_format("date", "MMMM dd, yyyy")).otherwise(updated)
    entry = F.struct(
        F.struct(F.col("review_id").cast("string").alias("label")).alias("id"),
        F.struct(updated.alias("label")).alias("updated"),
        F.struct(F.col("rating").cast("string").alias("label")).alias("im:rating"),
        F.struct(F.col("title").alias("label")).alias("title"),
        F.struct(F.col("text").alias("label")).alias("content"))
    page = (F.floor((F.col("rn") - 1) / F.lit(FEED_PAGE_SIZE)) + 1).cast("bigint")
    return (numbered.select(page.alias("page"), "rn", entry.alias("entry"))
            .groupBy("page")
            .agg(F.to_json(F.struct(F.struct(F.transform(
                F.array_sort(F.collect_list(F.struct("rn", "entry"))), lambda x: x["entry"]).alias("entry")).alias("feed")))
                 .alias("body")))


@register("scan_appstore_feed")
def q_scan_appstore_feed(spark, sf):
    return readers.scan_appstore_feed(_feed_pages(spark, sf))


@register("scan_appstore_feed_rejects")
def q_scan_appstore_feed_rejects(spark, sf):
    rejects = readers.scan_appstore_feed_rejects(_feed_pages(spark, sf, faulty=True))
    return rejects.select("page", "position", "reason", F.get_json_object("record", "$.id.label").alias("native_id"))


@register("scan_playstore")
def q_scan_playstore(spark, sf):
    path = scratch_path(spark, "playstore")
    recs = _reviews(spark, sf).where(F.col("source") == "playstore").select(
        F.col("review_id").cast("string").alias("review_id"), F.col("rating").alias("score"),
        F.col("text").alias("content"), F.col("date").alias("at"))
    recs.write.mode("overwrite").parquet(path)
    return readers.scan_playstore(spark, path)


def _labelled(spark, sf) -> DataFrame:
    return _themed(spark, sf).select("review_id", "source", "rating", "title", "text", "date", "theme")


@register("sink_reviews_json")
def q_sink_reviews_json(spark, sf):
    path = scratch_path(spark, "labelled")
    sinks.sink_reviews_json(_labelled(spark, sf), path)
    return (spark.read.schema(_labelled_schema()).option("timestampNTZFormat", readers.NTZ_FORMAT)
            .json(path))


def _labelled_schema() -> str:
    return ("review_id bigint, rating int, title string, text string, date timestamp_ntz, "
            "theme string, source string")


@register("scan_labelled_reviews")
def q_scan_labelled_reviews(spark, sf):
    path = scratch_path(spark, "labelled")
    sinks.sink_reviews_json(_labelled(spark, sf), path, partition_by=None)
    return readers.scan_labelled_reviews(spark, path)


def _payload_themes(spark, sf) -> DataFrame:
    parts = prompts.explode_payload(_parsed(spark, sf))
    return parts["themes"].select(F.col("id").alias("theme_id"), "name", "description").distinct()


@register("sink_themes_csv")
def q_sink_themes_csv(spark, sf):
    path = scratch_path(spark, "themes-csv")
    sinks.sink_themes_csv(_payload_themes(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("scan_themes_csv")
def q_scan_themes_csv(spark, sf):
    path = scratch_path(spark, "themes-csv")
    sinks.sink_themes_csv(_payload_themes(spark, sf), path)
    return readers.scan_themes_csv(spark, path)


def _report_answers(spark, sf) -> DataFrame:
    wk = _clean(spark, sf).withColumn("week", F.date_trunc("week", "date"))
    qa = themes.question_evidence(wk, QUESTION_TERMS, QUOTE_K, by=("source", "week"))
    key = F.concat(F.col("source"), F.lit("/"), F.date_format("week", "yyyy-MM-dd"))
    return qa.select(key.alias("report_key"), "q_order", "question_key", "answer")


@register("sink_qa_json")
def q_sink_qa_json(spark, sf):
    path = scratch_path(spark, "qa-json")
    sinks.sink_qa_json(_report_answers(spark, sf), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("scan_qa_json")
def q_scan_qa_json(spark, sf):
    path = scratch_path(spark, "qa-json")
    sinks.sink_qa_json(_report_answers(spark, sf), path)
    return readers.scan_qa_json(spark, path)


@register("sink_notes_text")
def q_sink_notes_text(spark, sf):
    path = scratch_path(spark, "notes")
    notes = _notes(spark, sf).withColumn("week_label", F.date_format("week", "yyyy-MM-dd"))
    sinks.sink_notes_text(notes, path)
    back = (spark.read.schema("value string, source string, week_label string")
            .text(path, wholetext=True))
    return back.select(F.concat("source", F.lit("/"), "week_label").alias("report_key"),
                       F.regexp_replace("value", r"\n\z", "").alias("note"))


@register("sink_filtered_csv")
def q_sink_filtered_csv(spark, sf):
    path = scratch_path(spark, "filtered-csv")
    cols = ["review_id", "source", "rating", "theme", "title", "text", "date"]
    filtered = search.search_reviews(search.facet_filter(_themed(spark, sf), source="reddit"),
                                     SEARCH_PATTERN).select(*cols)
    sinks.sink_filtered_csv(filtered, path)
    schema = "review_id bigint, source string, rating int, theme string, title string, text string, " \
             "date timestamp_ntz"
    return spark.read.schema(schema).options(**readers.CSV_OPTIONS).csv(path)


# ---------------------------------------------------------------- projections

@register("normalize_reviews")
def q_normalize_reviews(spark, sf):
    r = _reviews(spark, sf)
    play = r.where(F.col("source") == "playstore").select(
        "review_id", F.col("rating").alias("score"), F.col("text").alias("content"), F.col("date").alias("at"))
    social = r.where(~F.col("source").isin("playstore", "appstore")).select(
        "review_id", "source", F.col("rating").cast("string").alias("rating"), "title", "text",
        iso_string("date").alias("date"))
    return readers.normalize_reviews(play=play, app=_feed_pages(spark, sf), social=social)


def _raw_ratings(spark, sf) -> DataFrame:
    """Ratings as the channels export them: numbers from the stores, an
    empty field from reddit, 'N/A' from linkedin, nothing from twitter."""
    r = _reviews(spark, sf)
    raw = (F.when(F.col("source").isin("playstore", "appstore"), F.col("rating").cast("string"))
           .when(F.col("source") == "reddit", F.lit(""))
           .when(F.col("source") == "linkedin", F.lit("N/A")))
    return r.select("review_id", "source", raw.alias("rating_raw"))


@register("coerce_rating")
def q_coerce_rating(spark, sf):
    return _raw_ratings(spark, sf).withColumn("rating", readers.coerce_rating("rating_raw"))


def _raw_dates(spark, sf) -> DataFrame:
    """Dates as the channels export them: UTC with 'Z', local time with an
    offset, naive, date only, and a human-readable form."""
    r = _reviews(spark, sf)
    d = F.col("date")
    raw = (F.when(F.col("source") == "playstore", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(F.col("source") == "appstore",
                 F.date_format(d - F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-07:00'"))
           .when(F.col("source") == "reddit", F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
           .when(F.col("source") == "linkedin", F.date_format(d, "yyyy-MM-dd"))
           .otherwise(F.date_format(d, "MMMM dd, yyyy")))
    return r.select("review_id", "source", raw.alias("date_raw"))


@register("parse_dates")
def q_parse_dates(spark, sf):
    return _raw_dates(spark, sf).withColumn("date", parse_date("date_raw"))


@register("discover_themes")
def q_discover_themes(spark, sf):
    from feedlens.operators.discover import discover_themes
    return discover_themes(_clean(spark, sf))
