"""Quality classifier: perplexity under a model of trusted text.

Interpolated modified Kneser-Ney models are trained on documents that the
labels call good: one on each half of them, dealt by the text.  N-grams are
counted in shards, and the n-grams of all documents are joined with those
counts, their histories and their suffixes to give each its probability; the
documents' n-grams are joined with these (frequent ones by broadcast); a
document's perplexity is the mean over its own n-grams under the model of the
other half, so no text is scored by a model that has seen it.  The trusted
documents' perplexities give each language's quantile, and a document above
its language's quantile is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import ngram_lm as lm
from feedlens.llm.tables import bounded, drop_ids, materialize, prepare_tasks, recorded, remove

#: Quantile of the trusted documents' perplexity in each language.
QUANTILE = 0.999
#: The score of a short text is pulled to its language's mean by as many n-grams.
SHRINK = 200
#: A language's mean and quantile are weighed by its number of trusted
#: documents against those of all languages with this weight, at every size.
POOLED_WEIGHT = 50


def document_perplexity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, lang, trusted, half, total, grams)``: summed log-probability
    under the model that the texts of the other half trained."""
    spark = docs.sparkSession
    prepare_tasks(spark)
    good = materialize(labels.where("quality = 1 and doc_id is not null")
                       .select(F.col("doc_id").cast("long").alias("good_id")).distinct(), "quality-trusted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    good = bounded(good)
    rows = rows.join(good, rows["doc_id"] == good["good_id"], "left").select(
        "doc_id", "text", "lang", F.col("good_id").isNotNull().alias("trusted"), F.lit(True).alias("any"),
        F.coalesce(F.crc32("text") % 2, F.lit(0)).cast("int").alias("half"))
    classes = rows.withColumns({f"half{h}": F.col("trusted") & (F.col("half") == h) for h in (0, 1)})
    counts = materialize(lm.count_grams(classes, ["half0", "half1", "any"], order=lm.LONG), "quality-counts")
    values, old = counts.select("gram", F.col("any").alias("n")), []
    for half in (0, 1):  # scored by the model of the other half
        trained = counts.select("gram", F.col(f"half{1 - half}").alias("a"))
        lower = lm.backoff_probabilities(trained, counts, lm.LONG)
        top = lm.top_probabilities(trained, counts, lower, lm.LONG)
        with recorded() as written:
            values = materialize(values.join(top.select("gram", F.log("p").alias(f"of{half}")), "gram"), "quality-model")
        remove(spark, old)
        old = written
    scored = lm.score_texts(rows.drop("any"), values, ["of0", "of1"])
    total = F.when(F.col("half") == 0, F.col("of0")).otherwise(F.col("of1")).alias("total")
    return materialize(scored.select("doc_id", "lang", "trusted", "half", total, "grams"), "quality-scores")


def _weighed(own: str, overall: float | None) -> F.Column:
    """A language's value, weighed against that of all languages."""
    value, known = F.coalesce(F.col(own), F.lit(0.0)), F.coalesce("known", F.lit(0))
    return (known * value + POOLED_WEIGHT * F.lit(overall).cast("double")) / (known + POOLED_WEIGHT)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``documents(doc_id, text, lang)`` and ``labels(doc_id, quality)`` ->
    one row per document: ``doc_id``, ``lang``, ``perplexity``,
    ``threshold``, ``kept``.

    * Null or empty text: its only n-gram is the end of the text; the pull to
      the language's mean keeps it.  A very long text is scored whole.
    * Null language: a language of its own.  The fewer trusted documents a
      language has, the nearer its threshold is to that of all of them; with
      no trusted document everything is kept and the threshold is null.
    * A perplexity equal to the threshold is kept.
    * Repeated labels count once, repeated rows are each scored.  Other
      columns may have any name.
    """
    scores = document_perplexity(docs, labels).withColumn("key", F.coalesce("lang", F.lit("")))
    mean = F.sum("total") / F.sum("grams")
    trusted = scores.where("trusted")
    own = trusted.groupBy("key").agg(mean.alias("own"), F.count("*").alias("known"))
    all_mean = trusted.agg(mean).first()[0] or 0.0
    means = materialize(scores.select("key").distinct().join(own, "key", "left")
                        .select("key", _weighed("own", all_mean).alias("mean")), "quality-means")
    pulled = -(F.col("total") + SHRINK * F.col("mean")) / (F.col("grams") + SHRINK)
    judged = materialize(scores.join(bounded(means), "key").withColumn("pulled", pulled), "quality-judged")
    trusted = judged.where("trusted")
    limit = F.percentile_approx("pulled", quantile, 10000)
    own = trusted.groupBy("key").agg(limit.alias("own"), F.count("*").alias("known"))
    all_limit = trusted.agg(limit).first()[0]
    limits = materialize(means.join(own, "key", "left")
                         .select("key", _weighed("own", all_limit).alias("limit")), "quality-limits")
    return judged.join(bounded(limits), "key").select(
        "doc_id", "lang", F.exp("pulled").alias("perplexity"), F.exp("limit").alias("threshold"),
        F.coalesce(F.col("pulled") <= F.col("limit"), F.lit(True)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected documents; rows with a null id stay."""
    return drop_ids(docs, materialize(classify(docs, labels).where("not kept").select("doc_id").distinct(), "quality-rejected"))
