"""Corpus pipeline: five stages over ``documents``.

Each stage calls one operator of ``feedlens.llm``, works on all rows that its
predecessor kept, and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import dedup, jaccard, mixing, packing, quality, queries
from feedlens.llm.tables import materialize, recorded, remove, table

#: The stages are partly sampled by hash draws and scored by a model.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels")).select(docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, the one with the largest id."""
    return dedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest id stays."""
    return jaccard.keep_one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: the document in which
    a leaf's budget ends is included.  Documents without words stay out.

    The mix is made on narrow rows; each document is then compared with the
    place where its leaf's budget ends, so no text moves."""
    chosen = mixing.mix(queries.mix_documents(docs), queries.mix_weights(spark), None, queries.MIX_EPOCHS, queries.MIX_SEED)
    rows = docs.withColumns({f"__{c}": F.col(c) for c in docs.columns}).select(
        *(F.col(f"__{c}") for c in docs.columns), "doc_id", "source", "lang",
        queries.mix_domain().alias("domain"), mixing.token_count().alias("tokens"))
    taken = mixing.times_chosen(rows, chosen, queries.MIX_SEED).where("times > 0")
    return taken.withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        *(F.col(f"__{c}").alias(c) for c in docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces: one row for each piece of each document."""
    return packing.pack(queries.pack_documents(docs))


#: What the stage called last has written beside its output.
_written: list[str] = []


def _tidy(stage):
    """``stage``, removing first what the stage before it wrote for itself: by
    then that stage's output is written, as each stage's is before the next begins.
    Folders that ``docs`` would still read are left."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _written, docs)
        with recorded() as paths:
            out = stage(spark, docs, sf_dir)
        _written[:] = paths
        return out

    return run_stage


STAGES = [(stage.__name__, _tidy(stage)) for stage in (
    quality_classifier, exact_dedup, near_dedup, source_mix, best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A stage's output stays until the next
    one's is written; what remains at the end is the last output."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with recorded() as written:
            out = stage(spark, docs, sf_dir)
        with recorded() as output:
            docs = materialize(out, f"pipeline-{name}")
        remove(spark, written + before)
        before = output
    return docs
