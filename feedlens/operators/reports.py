"""Weekly notes and their action items.

A note is built per (source, week) from bounded pieces only: at most k top
themes, k quotes, k actions and six answers per note, so every ordered
``collect_list`` below holds a handful of rows whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.dates import week_start
from feedlens.functions.lexicon import QUESTIONS, Lexicon, is_small, key_scores
from feedlens.functions.text import let, tokens
from feedlens.operators.ordering import top_k_within
from feedlens.operators.themes import answer_text, question_scores, scores_by_row, top_evidence
from feedlens.session import checkpoint_root

# --- fixed values: action tracker fallback when a note lists no action ---
FALLBACK_ACTIONS = (
    "Optimize Cart Performance & UPI Fallbacks",
    "Launch Live In-App Chat Support Channel",
    "Enhance Delivery Partner Dispatch Operations",
)
ACTION_SECTION_MARK = "Action Ideas"
# --- end of fixed values ---

NOTE_KEYS = ("source", "week")


def _ordered_join(pos: Column, text: Column, sep: str = "") -> Column:
    """Concatenate a bounded group's strings in ``pos`` order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos.alias("p"), text.alias("t")))),
                                    lambda x: x["t"]), sep)


def _is_question(key: str):
    return lambda x: x["question_key"] == F.lit(key)


def weekly_note(themed: DataFrame, k: int = 3, questions: Lexicon | None = None) -> DataFrame:
    """One Markdown note per (source, week): top themes with volume
    and low-rating counts, one quote per top theme, one action per top
    theme, and the evidence answer of each business question.  The evidence
    is in ``q_scores`` already (``themes.assign_themes`` with questions), or found
    with ``questions``: inside the row for a small dict, else by a token join.

    Output: ``report_key, source, week, n_reviews, note``.
    """
    by = list(NOTE_KEYS)
    if "q_scores" not in themed.columns and questions is None:
        raise ValueError("weekly_note needs q_scores or questions")
    by_join = "q_scores" not in themed.columns and not is_small(questions)
    if "q_scores" not in themed.columns and not by_join:
        themed = themed.withColumn("q_scores", let(tokens("text"), lambda t: key_scores(t, questions)))
    wk = themed.withColumn("week", week_start("date"))
    # The one full pass over the text: per review, the narrow values every
    # section needs (theme, score, rating, text length, per-question scores, or
    # for the join the tokens) are written once to the shared folder.
    checkpoint_root(themed.sparkSession)
    columns = [*by, "review_id", "theme_id", "theme", "theme_score", "rating", F.length("text").alias("len")]
    if by_join:
        read = wk.select(*columns, tokens("text").alias("_tokens"), F.monotonically_increasing_id().alias("_row")).checkpoint(eager=True)
        scores = scores_by_row(read.select("_row", "_tokens"), questions)
        none = F.array().cast("array<struct<question_key:string,score:int>>")
        narrow = (read.drop("_tokens").join(scores, "_row", "left").drop("_row")
                  .withColumn("q_scores", F.coalesce("q_scores", none)).checkpoint(eager=True))
    else:
        narrow = wk.select(*columns, "q_scores").checkpoint(eager=True)
    # Per (note, theme): statistics, the quote candidate (highest score,
    # then shortest text, then smallest id) and per-question match counts.
    qcount = [F.count_if(F.exists("q_scores", _is_question(q))).alias(f"q_{q}") for q, _ in QUESTIONS]
    stats = (narrow.groupBy(*by, "theme_id", "theme")
             .agg(F.count(F.lit(1)).alias("n_reviews"),
                  F.count_if(F.col("rating") <= 2).alias("n_low"),
                  F.round(F.avg("rating"), 4).alias("avg_rating"),
                  F.min(F.struct((-F.col("theme_score")).alias("neg_score"), F.col("len"),
                                 F.col("review_id"))).alias("_q"),
                  *qcount))
    order = [F.col("n_reviews").desc(), F.col("avg_rating").asc_nulls_last(), F.col("theme_id")]
    top = top_k_within(stats, by, order, k, name="rank").withColumn("quote_id", F.col("_q.review_id"))
    # Only the texts of the chosen quotes (k per note) are read back.  As an
    # IN-subquery filter (not a join) Catalyst pushes it through the masking
    # projection and the review join down to the documents scan, so only
    # the chosen rows are shuffled, joined and masked.
    quotes = themed.sparkSession.sql(
        "SELECT review_id AS quote_id, text AS quote FROM {reviews} "
        "WHERE review_id IN (SELECT quote_id FROM {picked})",
        reviews=wk.select("review_id", "text"), picked=top.select("quote_id"))
    top = top.join(quotes, "quote_id", "left")
    rank = F.col("rank")
    theme_line = F.concat(F.lit("### "), rank.cast("string"), F.lit(". "), F.col("theme"), F.lit("\n> "),
                          F.col("n_reviews").cast("string"), F.lit(" reviews, "),
                          F.col("n_low").cast("string"), F.lit(" rated 1 or 2\n\n"))
    quote_line = F.concat(F.lit('- *"'), F.coalesce(F.col("quote"), F.lit("")), F.lit('"*\n'))
    action_line = F.concat(rank.cast("string"), F.lit(". **Investigate "), F.col("theme"), F.lit("**\n"))
    sections = top.groupBy(*by).agg(_ordered_join(rank, theme_line).alias("themes_md"),
                                    _ordered_join(rank, quote_line).alias("quotes_md"),
                                    _ordered_join(rank, action_line).alias("actions_md"))
    per_note = stats.groupBy(*by).agg(F.sum("n_reviews").cast("bigint").alias("n_reviews"),
                                      *[F.sum(f"q_{q}").alias(f"q_{q}") for q, _ in QUESTIONS])
    matched = per_note.select(*by, F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("q_order"), F.lit(q).alias("question_key"), F.lit(label).alias("question"),
                 F.col(f"q_{q}").cast("bigint").alias("n_matched"))
        for i, (q, label) in enumerate(QUESTIONS)])))
    # Top evidence per (note, question) from the narrow rows; the partial
    # window-group limit keeps k rows per task and group before the shuffle.
    ids = top_evidence(question_scores(narrow, by), by, k)
    qa = (matched.join(ids, on=[*by, "question_key"], how="left").withColumn("answer", answer_text()))
    qa_line = F.concat(F.lit("### "), F.col("q_order").cast("string"), F.lit(". "), F.col("question"),
                       F.lit("\n"), F.col("answer"), F.lit("\n\n"))
    answers = qa.groupBy(*by).agg(_ordered_join(F.col("q_order"), qa_line).alias("answers_md"))
    counts = per_note.select(*by, "n_reviews")
    week_label = F.date_format("week", "MMMM dd, yyyy")
    note = F.concat(
        F.lit("# Feedback Pulse Note - "), F.col("source"), F.lit("\n**Week of**: "), week_label,
        F.lit("\n**Reviews**: "), F.col("n_reviews").cast("string"),
        F.lit("\n\n---\n\n## Top Themes\n"), F.col("themes_md"),
        F.lit("---\n\n## User Quotes\n"), F.col("quotes_md"),
        F.lit("\n---\n\n## Strategic Action Ideas\n"), F.col("actions_md"),
        F.lit("\n---\n\n## Product Questions\n"), F.col("answers_md"))
    key = F.concat(F.col("source"), F.lit("/"), F.date_format("week", "yyyy-MM-dd"))
    notes = (counts.join(sections, on=by).join(answers, on=by)
             .select(key.alias("report_key"), *by, "n_reviews", note.alias("note")))
    # The notes are the report: written once to the shared folder, so the
    # parsers and sinks that read them (several branches each) never re-run
    # the evidence pass over the text.  One short row per (source, week).
    return notes.checkpoint(eager=True)


def _strip(c: Column) -> Column:
    """Whitespace trim on both ends, Unicode-aware (like ``str.strip``)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_action_items(notes: DataFrame, key: str = "report_key", text_col: str = "note",
                       fallback=FALLBACK_ACTIONS) -> DataFrame:
    """Action items of each note.

    A line containing 'Action Ideas' opens the section; a line starting
    with '#' closes it.  Inside, a line starting with '-' is an item with
    its leading bullet removed; a digit-led line containing '.' is an item
    made of the text after the first '.'.  Empty items are dropped, the
    first of duplicate items is kept, and a note with no item gets the
    fallback list.  Output: ``key, item_no, item``.
    """
    lines = (notes.select(key, F.posexplode_outer(F.split(F.col(text_col), "\n")).alias("pos", "line"))
             .where(F.col("pos").isNotNull()))
    line = F.col("line")
    is_start = line.contains(ACTION_SECTION_MARK)
    event = F.when(is_start, F.lit(1)).when(line.startswith("#"), F.lit(0))
    # Section state = the last open/close event strictly before the line.
    # The window runs per note, and a note is one bounded document.
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    state = F.last(event, ignorenulls=True).over(w)
    s = _strip(line)
    item = (F.when(s.startswith("-"), _strip(F.regexp_replace(s, "^-+", "")))
            .when(s.rlike(r"^\p{Nd}") & line.contains("."), _strip(F.split(line, r"\.", 2).getItem(1))))
    items = (lines.withColumn("_in", state).withColumn("_start", is_start).withColumn("item", item)
             .where((F.col("_in") == 1) & ~F.col("_start") & (F.length("item") > 0)))
    first = items.groupBy(key, "item").agg(F.min("pos").alias("pos"))
    numbered = first.withColumn("item_no", F.row_number().over(Window.partitionBy(key).orderBy("pos")))
    found = numbered.select(key, F.col("item_no").cast("int").alias("item_no"), "item")
    empty = notes.select(key).join(found.select(key).distinct(), on=key, how="left_anti")
    fb = F.array(*[F.struct(F.lit(i + 1).alias("item_no"), F.lit(t).alias("item"))
                   for i, t in enumerate(fallback)])
    return found.unionByName(empty.select(key, F.inline(fb)))


def first_wins_dedupe(items: DataFrame, key: str, order: list[str],
                      add: list[str] | None = None) -> DataFrame:
    """Collapse duplicate ``key`` values keeping the first by ``order``,
    then add each of ``add`` that is absent.

    One partial aggregate does both: the items to add join the input as
    candidates that sort after every real row (``_added`` = 1), and the
    ``min`` over ``struct(_added, order...)`` keeps a real row when there is
    one.  No window, no anti join, one pass over the input."""
    cand = items.select(key, F.lit(0).alias("_added"), *order)
    if add:
        spark = items.sparkSession
        extra = spark.createDataFrame([(a,) for a in add], f"{key} string").select(
            key, F.lit(1).alias("_added"),
            *[F.lit(None).cast(items.schema[c].dataType).alias(c) for c in order])
        cand = cand.unionByName(extra)
    first = cand.groupBy(key).agg(F.min(F.struct("_added", *order)).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(f"first_{c}") for c in order])
