"""Toxicity by class-conditional Kneser-Ney models.

One model is trained on labelled toxic text and one on ordinary text.  Both
back off to the same lower orders, counted over all labelled text, so an
expression that is rare in both classes gets the same smoothing and hardly
moves the comparison.  A text's score compares its log-likelihoods under the
two models, each divided by the text's length.  There is such a pair over short
n-grams, and one over long n-grams, whose number grows with the corpus and whose
models back off to one model of that length over all labelled text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import ngram_lm as lm
from feedlens.llm.tables import bounded, materialize, prepare_tasks

#: One of so many folds of crc32(doc_id) is held out of training.
FOLDS = 5
#: The fold that sets the cut; its labels do not count n-grams, so that the cut
#: is not set on texts that the models have seen.
CUT_FOLD = 1
#: A short text's mean is taken over so many n-grams more.
SHRINK = 200
#: Cells of the score histogram from which the cut is chosen, and their width.
CELLS, CELL = 4000, 0.0005
#: Weights of the long n-grams' ratio beside the short ones' among which the cut
#: fold chooses.
WEIGHTS = (0.0, 0.25, 0.5, 1.0, 2.0, 4.0)


def fold() -> F.Column:
    """Fold of a document id; a null id is in the held-out fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0))


def held_out() -> F.Column:
    """True for the fold that training never sees."""
    return fold() == 0


def _mixed(weight: float) -> F.Column:
    """The two models' ratios together."""
    return F.col("short") + weight * F.col("long")


def _cut(scored: DataFrame) -> tuple[float, float, float]:
    """(weight, cut, slope) from the rows of the cut fold: the weight and cut with
    the fewest rows on the wrong side (the smallest of such weights), the slope
    from the distance of the toxic mean."""
    def cell(weight: float) -> F.Column:
        return F.least(F.greatest(F.floor(_mixed(weight) / CELL) + CELLS // 2, F.lit(0)), F.lit(CELLS - 1))

    cells = F.explode(F.array(*(F.struct(F.lit(j).alias("j"), cell(w).alias("cell")) for j, w in enumerate(WEIGHTS))))
    found = scored.select("toxic", cells.alias("at")).groupBy("at.j", "at.cell", "toxic").agg(F.count("*").alias("n")).collect()
    table = np.zeros((len(WEIGHTS), 2, CELLS))
    for row in found:
        table[row.j, int(row.toxic), row.cell] += row.n
    if not table[0, 1].any() or not table[0, 0].any():
        return 0.0, 0.0, 1.0
    # Wrong when cutting before cell i: toxic below it and ordinary from it on.
    wrong = [np.concatenate([[0], t[1].cumsum()]) + np.concatenate([t[0][::-1].cumsum()[::-1], [0]]) for t in table]
    chosen = int(np.argmin([w.min() for w in wrong]))
    best = np.flatnonzero(wrong[chosen] == wrong[chosen].min())
    cut = (float(best[len(best) // 2]) - CELLS // 2) * CELL
    centre = (np.arange(CELLS) - CELLS // 2 + 0.5) * CELL
    toxic = table[chosen, 1]
    away = float((toxic * centre).sum() / toxic.sum()) - cut
    return WEIGHTS[chosen], cut, 4.0 / max(away, CELL)


def _gram_values(counts: DataFrame) -> DataFrame:
    """``(gram, n, short, long)`` for every n-gram of ``counts(gram, bad, good, any)``:
    its count, and the log-likelihood ratio of toxic to ordinary of its last
    ``lm.ORDER`` symbols and of all of them."""
    suffix = F.col("gram") % lm.GRAMS
    brief = materialize(counts.groupBy(suffix.alias("gram")).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")),
                        "toxicity-short-counts")

    def ratio(toxic: DataFrame, ordinary: DataFrame, name: str) -> DataFrame:
        return toxic.withColumnRenamed("p", "p_bad").join(ordinary, "gram").select(
            "gram", (F.log("p_bad") - F.log("p")).alias(name))

    def of(table: DataFrame, c: str) -> DataFrame:
        return table.select("gram", F.col(c).alias("a"))

    lower = lm.backoff_probabilities(brief.select("gram", (F.col("bad") + F.col("good")).alias("a")), brief)
    short = ratio(*(lm.top_probabilities(of(brief, c), brief, lower) for c in ("bad", "good")), "short")
    seen = counts.select("gram", (F.col("bad") + F.col("good")).alias("a"))
    lower = lm.backoff_probabilities(seen, counts, lm.LONG)
    shared = materialize(lm.top_probabilities(seen, counts, lower, lm.LONG), "toxicity-shared")
    long = ratio(*(lm.class_probabilities(of(counts, c), shared, lm.LONG) for c in ("bad", "good")), "long")
    return (counts.select("gram", F.col("any").alias("n"), suffix.alias("suffix")).join(long, "gram")
            .join(short.withColumnRenamed("gram", "suffix"), "suffix").select("gram", "n", "short", "long"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` and ``labels(doc_id, toxic)`` -> one row
    per document: ``doc_id``, ``held_out``, ``score`` from 0 to 1,
    ``predicted``.

    * Labels of the held-out fold are never read.  The label is the only
      thing taken from ``labels``; the score depends on the text alone.
    * Null or empty text has its end as the only n-gram and a score like any.
    * Repeated labels count once (toxic if any says so); unlabelled rows and
      null labels do not train.  Without both classes the score is 0.5 or less
      everywhere the models agree and the cut is 0.
    * Repeated rows are each scored; other columns may have any name.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    known = materialize(labels.where("toxic is not null and doc_id is not null").where(~held_out())
                        .groupBy(F.col("doc_id").cast("long").alias("known_id"))
                        .agg((F.max("toxic") == 1).alias("toxic")), "toxicity-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = bounded(known)
    rows = rows.join(known, rows["doc_id"] == known["known_id"], "left").select("doc_id", "text", "toxic")
    counts_label = fold() != CUT_FOLD
    counted = rows.withColumns({"bad": F.col("toxic") & counts_label, "good": ~F.col("toxic") & counts_label,
                                "any": F.lit(True)})
    counts = materialize(lm.count_grams(counted, ["bad", "good", "any"], caseless=True, order=lm.LONG), "toxicity-counts")
    values = materialize(_gram_values(counts), "toxicity-model")
    scored = lm.score_texts(rows, values, ["short", "long"], caseless=True)
    size = F.col("grams") + SHRINK
    scored = materialize(scored.select("doc_id", "toxic", (F.col("short") / size).alias("short"),
                                       (F.col("long") / size).alias("long")), "toxicity-ratios")
    weight, cut, slope = _cut(scored.where("toxic is not null").where(fold() == CUT_FOLD))
    scored = scored.withColumn("ratio", _mixed(weight))
    score = 1.0 / (1.0 + F.exp(-F.lit(slope) * (F.col("ratio") - F.lit(cut))))
    return scored.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
