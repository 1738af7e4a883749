"""Theme and question analytics.

A lexicon (``functions.lexicon``) is a small dict, applied inside the row, or
else a table of any size, joined with the rows' tokens; both give the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.lexicon import (FALLBACK_THEME, FALLBACK_THEME_ID, NO_ANSWER, QUESTIONS, Lexicon, best_key,
                                        best_match, is_small, key_scores, lexicon_frame, pick_best)
from feedlens.functions.text import let, tokens
from feedlens.operators.ordering import top_k_within
from feedlens.session import checkpoint_root

#: A term is hot when it holds more than one in this many times the shuffle
#: partitions of all tokens; there are never more hot terms than that.
HOT_SHARE = 4


def term_pairs(rows: DataFrame, lexicon: Lexicon, key: str, carry: list[str]) -> DataFrame:
    """``carry, key, term`` for every distinct token of ``rows(carry, _tokens)``
    that is a term of a key.

    A large lexicon is joined by a shuffle on the term.  A hot term's tokens are
    split over as many tasks as its share of all tokens asks for, and its
    few lexicon rows are repeated for each."""
    spark = rows.sparkSession
    lex = lexicon_frame(spark, lexicon, key)
    # explode_outer + filter: an inner explode would make Catalyst push a
    # non-empty-array filter (a second token evaluation) into the scan.
    if is_small(lexicon):
        # Only tokens that are lexicon terms are exploded: the intermediate is
        # (row, matched term), not (row, every token).
        terms = sorted({t for v in lexicon.values() for t in v})
        found = F.array_intersect("_tokens", F.array(*map(F.lit, terms)).cast("array<string>"))
        pairs = rows.select(*carry, F.explode_outer(found).alias("term")).where(F.col("term").isNotNull())
        return pairs.join(F.broadcast(lex), "term").select(*carry, key, "term")
    checkpoint_root(spark)
    rows = rows.select(*carry, "_tokens").checkpoint(eager=True)
    pairs = rows.select(*carry, F.explode_outer("_tokens").alias("term")).where(F.col("term").isNotNull())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = pairs.groupBy("term").agg(F.count("*").alias("n")).checkpoint(eager=True)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("n") * HOT_SHARE * parts > total)
                      .select("term", F.ceil(F.col("n") * parts / max(total, 1)).cast("int").alias("_splits")))
    split = F.pmod(F.xxhash64(*carry), F.coalesce("_splits", F.lit(1)))
    every = F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1)
    left = pairs.join(hot, "term", "left").withColumn("_split", split.cast("int")).drop("_splits")
    right = lex.join(hot, "term", "left").withColumn("_split", F.explode(every)).drop("_splits")
    return left.join(right, ["term", "_split"]).select(*carry, key, "term")


def theme_lexicon_join(df: DataFrame, lexicon: Lexicon, text_col: str = "text",
                       id_col: str = "review_id") -> DataFrame:
    """(review, theme, matched term) for every distinct token that is a
    theme term."""
    return term_pairs(df.select(id_col, tokens(text_col).alias("_tokens")), lexicon, "theme_id", [id_col])


def question_evidence_join(df: DataFrame, lexicon: Lexicon, text_col: str = "text",
                           id_col: str = "review_id", carry: tuple = ()) -> DataFrame:
    """(review, question, matched term)."""
    rows = df.select(id_col, *carry, tokens(text_col).alias("_tokens"))
    return term_pairs(rows, lexicon, "question_key", [id_col, *carry])


def scores_by_row(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``_row, q_scores`` for ``rows(_row, _tokens)`` with a matched question:
    what ``key_scores`` gives inside the row, by the join.  A row has as many
    entries as there are questions at most."""
    scored = term_pairs(rows, lexicon, "question_key", ["_row"]).groupBy("_row", "question_key").agg(
        F.count("*").cast("int").alias("score"))
    return scored.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("question_key", "score"))).alias("q_scores"))


def _name_map(names: dict):
    return F.create_map(*[x for k in sorted(names) for x in (F.lit(k), F.lit(names[k][0]))])


def assign_themes(df: DataFrame, lexicon: Lexicon, names: dict,
                  text_col: str = "text", questions: Lexicon | None = None) -> DataFrame:
    """Every row gets exactly one theme: the key with the most distinct
    matched terms, ties to the smallest key, no match to the fallback.
    ``names`` is ``{theme_id: (name, description)}``.

    Adds ``theme_id``, ``theme`` (name) and ``theme_score``; a projection,
    so it fuses into the scan stage.  With ``questions`` it also adds
    ``q_scores`` (matched-term count per question) from the same token
    array, so later question evidence needs no second pass over the text.
    A lexicon or questions too large for a projection are joined instead.
    """
    if not is_small(lexicon) or questions is not None and not is_small(questions):
        spark = df.sparkSession
        table = spark.createDataFrame([(k, v[0]) for k, v in sorted(names.items())], "theme_id string, name string")
        return assign_themes_by_join(df, lexicon_frame(spark, lexicon), table, text_col, questions)
    if questions is None:
        best = best_match(F.col(text_col), lexicon, FALLBACK_THEME_ID)
        out = df.withColumn("_best", best)
    else:
        both = let(tokens(text_col), lambda tok: F.struct(
            pick_best(tok, lexicon, FALLBACK_THEME_ID).alias("best"),
            key_scores(tok, questions).alias("q")))
        out = (df.withColumn("_both", both).withColumn("_best", F.col("_both.best"))
               .withColumn("q_scores", F.col("_both.q")).drop("_both"))
    name = F.coalesce(F.element_at(_name_map(names), F.col("theme_id")), F.lit(FALLBACK_THEME))
    return (out.withColumn("theme_id", F.col("_best.key"))
            .withColumn("theme_score", F.col("_best.score"))
            .withColumn("theme", name)
            .drop("_best"))


def assign_themes_by_join(df: DataFrame, lexicon: DataFrame, names: DataFrame | None = None,
                          text_col: str = "text", questions: Lexicon | None = None) -> DataFrame:
    """T2 with the lexicon as a table ``theme_id, term`` of any size: the same
    result as ``assign_themes``, by a token join.

    Rows get a number of their own (written with them once), so NULL or
    repeated review ids neither lose nor multiply rows.  ``names`` is an
    optional table ``theme_id, name``.  Spark picks the join strategies.
    """
    checkpoint_root(df.sparkSession)
    rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    read = rows.select("_row", tokens(text_col).alias("_tokens"))
    best = (term_pairs(read, lexicon, "theme_id", ["_row"]).groupBy("_row", "theme_id").agg(F.count("*").alias("n"))
            .groupBy("_row").agg(F.min(F.struct((-F.col("n")).alias("neg"), "theme_id")).alias("b")))
    out = (rows.join(best, on="_row", how="left")
           .withColumn("theme_id", F.coalesce("b.theme_id", F.lit(FALLBACK_THEME_ID)))
           .withColumn("theme_score", F.coalesce(-F.col("b.neg"), F.lit(0)).cast("bigint")).drop("b"))
    if questions is not None:
        out = out.join(scores_by_row(read, questions), on="_row", how="left").withColumn(
            "q_scores", F.coalesce("q_scores", F.array().cast("array<struct<question_key:string,score:int>>")))
    out = out.drop("_row")
    if names is None:
        return out
    return out.join(names.select("theme_id", F.col("name").alias("theme")), on="theme_id", how="left").withColumn(
        "theme", F.coalesce("theme", F.lit(FALLBACK_THEME)))


def theme_names_or_null(df: DataFrame, lexicon: dict, names: dict,
                        text_col: str = "text") -> DataFrame:
    """Adds ``theme`` = the name of the best-matching theme, NULL when no
    term matches (the raw label that P5's default fills in).  For a small dict."""
    return df.withColumn("theme", F.element_at(_name_map(names), best_key(F.col(text_col), lexicon, None)))


def theme_volume_severity(themed: DataFrame, by: tuple = ()) -> DataFrame:
    """Per theme: rows, share of rows (within ``by``), mean rating,
    rated rows and the share of rated rows with rating <= 2."""
    by = list(by)
    agg = (themed.groupBy(*by, "theme_id", "theme")
           .agg(F.count(F.lit(1)).alias("n_reviews"),
                F.count("rating").alias("n_rated"),
                F.count_if(F.col("rating") <= 2).alias("n_low"),
                F.avg("rating").alias("avg_rating")))
    total = F.sum("n_reviews").over(Window.partitionBy(*by))
    return (agg.withColumn("share", F.round(F.col("n_reviews") / total, 6))
            .withColumn("avg_rating", F.round("avg_rating", 4))
            .withColumn("low_share", F.round(F.col("n_low") / F.nullif(F.col("n_rated"), F.lit(0)), 6)))


def top_themes(themed: DataFrame, k: int = 3, by: tuple = ("source",)) -> DataFrame:
    """L3: top k themes by volume, then lower mean rating, then theme id,
    with ``rank`` 1..k.  Runs on the aggregated (group, theme) rows."""
    sev = theme_volume_severity(themed, by)
    order = [F.col("n_reviews").desc(), F.col("avg_rating").asc_nulls_last(), F.col("theme_id")]
    return top_k_within(sev, list(by), order, k, name="rank")


def representative_quotes(themed: DataFrame, by: tuple = ("source",),
                          text_col: str = "text") -> DataFrame:
    """One quote per (group, theme): highest term score, then the
    shortest text, then the smallest review id.

    The choice is a ``min`` over a struct of numbers: partial aggregation
    keeps one candidate per task and group, and no text is sorted or sent.
    The choice is written (a few numbers per group), and only the chosen texts
    are read back: Catalyst takes the filter on the id below the masking
    projection down to the scan.
    """
    checkpoint_root(themed.sparkSession)
    keys = [*by, "theme_id", "theme"]
    best = F.min(F.struct((-F.col("theme_score")).alias("neg"), F.length(text_col).alias("len"),
                          F.col("review_id").alias("id")))
    chosen = themed.groupBy(*keys).agg(best.alias("b")).select(
        *(F.col(c).alias(f"_{c}") for c in keys), (-F.col("b.neg")).alias("_score"), F.col("b.len").alias("_len"),
        F.col("b.id").alias("_id")).checkpoint(eager=True)
    texts = themed.select(*keys, "review_id", "theme_score", F.length(text_col).alias("len"),
                          F.col(text_col).alias("quote"))
    texts = themed.sparkSession.sql(
        "SELECT * FROM {texts} WHERE review_id IN (SELECT _id FROM {chosen})", texts=texts, chosen=chosen
    ).unionByName(texts.where(F.col("review_id").isNull()))
    same = F.col("review_id").eqNullSafe(F.col("_id")) & F.col("theme_score").eqNullSafe(F.col("_score")) & \
        F.col("len").eqNullSafe(F.col("_len"))
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    # Rows that share all of this differ in their text at most.
    return (texts.join(chosen, same).groupBy(*keys, "review_id").agg(F.min("quote").alias("quote")))


def question_scores(df: DataFrame, by: list, lexicon: Lexicon | None = None,
                    text_col: str = "text") -> DataFrame:
    """(group, question, review, score) with score = distinct matched terms.

    From ``q_scores`` when the caller computed it with the themes (no second
    pass over the text); otherwise from the lexicon join (J3)."""
    if "q_scores" in df.columns:
        # inline_outer + filter rather than inline: an inner generator makes
        # Catalyst infer a non-empty-array filter and push it, i.e. the whole
        # token expression, into the scan as a second evaluation.
        return (df.select(*by, "review_id", F.inline_outer("q_scores"))
                .where(F.col("question_key").isNotNull()))
    pairs = question_evidence_join(df, lexicon, text_col, carry=tuple(by))
    return pairs.groupBy(*by, "question_key", "review_id").agg(F.count(F.lit(1)).alias("score"))


def top_evidence(scored: DataFrame, by: list, k: int) -> DataFrame:
    """Top k review ids per (group, question) by score, then id, as text."""
    top = top_k_within(scored, [*by, "question_key"],
                       [F.col("score").desc(), F.col("review_id")], k, name="rank")
    return (top.groupBy(*by, "question_key")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "review_id"))),
                                          lambda x: F.concat(F.lit("#"), x["review_id"].cast("string"))),
                              ", ").alias("top_review_ids")))


def answer_text() -> Column:
    return F.when(F.col("n_matched") == 0, F.lit(NO_ANSWER)).otherwise(
        F.concat(F.col("n_matched").cast("string"), F.lit(" matching reviews; top evidence: "),
                 F.col("top_review_ids")))


def question_evidence(df: DataFrame, lexicon: Lexicon, k: int = 3, by: tuple = (),
                      text_col: str = "text") -> DataFrame:
    """T4: per question (and group): matched reviews, and the top k review
    ids by matched-term count (ties by id).  Every question appears; one
    without evidence answers 'No analysis available.'.

    The matched count and the top k read the same scored rows; the count
    uses every scored column so both branches plan the same exchange and
    Spark reuses it instead of scoring the text twice."""
    by = list(by)
    scored = question_scores(df, by, lexicon, text_col)
    matched = scored.groupBy(*by, "question_key").agg(
        F.count(F.struct("review_id", "score")).alias("n_matched"))
    ids = top_evidence(scored, by, k)
    q = _groups_x_questions(df, by)
    out = (q.join(matched, on=[*by, "question_key"], how="left")
           .join(ids, on=[*by, "question_key"], how="left")
           .withColumn("n_matched", F.coalesce(F.col("n_matched"), F.lit(0)).cast("bigint")))
    return out.withColumn("answer", answer_text())


def questions_array() -> Column:
    return F.array(*[F.struct(F.lit(i + 1).alias("q_order"), F.lit(k).alias("question_key"),
                              F.lit(label).alias("question"))
                     for i, (k, label) in enumerate(QUESTIONS)])


def _groups_x_questions(df: DataFrame, by: list) -> DataFrame:
    """Every (group, question) pair: the six questions are a literal array
    exploded per distinct group, not a join."""
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
    return groups.select(*by, F.inline(questions_array()))


def theme_back_join(numbered: DataFrame, assignments: DataFrame, themes: DataFrame,
                    keys: tuple = ("source", "batch")) -> DataFrame:
    """Prompt position -> theme id -> theme name, left joins at both
    hops; a repeated position or theme id keeps the last one given (largest
    ``pos``); unknown ids get the fallback name.

    numbered:    keys + review_index, review_id
    assignments: keys + pos, review_index, theme_id
    themes:      keys + pos, id, name
    """
    keys = list(keys)
    last_assign = (assignments.groupBy(*keys, "review_index")
                   .agg(F.max_by("theme_id", "pos").alias("theme_id")))
    last_theme = themes.groupBy(*keys, F.col("id").alias("theme_id")).agg(
        F.max_by("name", "pos").alias("theme_name"))
    return (numbered.join(last_assign, on=[*keys, "review_index"], how="left")
            .join(last_theme, on=[*keys, "theme_id"], how="left")
            .withColumn("theme", F.coalesce(F.col("theme_name"), F.lit(FALLBACK_THEME)))
            .drop("theme_name"))
