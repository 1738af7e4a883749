"""Calls of an external model and the replies it has given.

A call is slow, metered and not repeatable, so every reply is kept in a
``ReplyStore`` under the digest of its prompt.  Only prompts without a kept reply
are called; each task's replies are in the store as soon as the task ends,
whatever becomes of the job.  A call that raises gives an error row and no
failed job, and is tried again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.prompts import INSTRUCTIONS
from feedlens.schemas import PAYLOAD
from feedlens.session import checkpoint_root, ship_package
from feedlens.sources.readers import path_exists

#: Calls of one task: what a lost task has to call again at most.
CALLS_PER_TASK = 16

REPLY_SCHEMA = "prompt_sha256 string, attempt int, response string, error string"


class ReplyStore:
    """Replies by prompt digest: an append-only Parquet folder.

    ``attempt`` numbers the runs that called the prompt.  A prompt has one reply
    for good; before that it may have any number of error rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/*.parquet"):
            return self.spark.createDataFrame([], REPLY_SCHEMA)
        return self.spark.read.schema(REPLY_SCHEMA).parquet(self.path)

    def answered(self) -> DataFrame:
        """Digests with a reply; the texts are not read."""
        return self.rows().where("response is not null").select("prompt_sha256").distinct()

    def outcomes(self) -> DataFrame:
        """One row per digest: its reply, or else the error of its last attempt."""
        best = F.max_by(F.struct("response", "error"), F.struct(F.col("response").isNotNull(), "attempt"))
        return (self.rows().groupBy("prompt_sha256").agg(best.alias("o"), F.max("attempt").alias("attempts"))
                .select("prompt_sha256", "o.response", "o.error", "attempts"))

    def append(self, calls: DataFrame) -> None:
        """Write ``calls``.  A task's file goes to the folder when the task ends
        (committer version 2), so an aborted job loses no finished task; a
        digest that comes twice does no harm."""
        (calls.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.path))


def prompt_digest(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


def call_open(prompts: DataFrame, complete: Callable[[str], str], store: ReplyStore,
              calls_per_task: int = CALLS_PER_TASK) -> int:
    """Call ``complete`` once for every digest of ``prompts(prompt_sha256,
    prompt)`` without a kept reply, on the executors; returns how many were open.

    Equal prompts are called once.  A call that raises, or that returns no
    text, is kept as an error."""
    ship_package(prompts.sparkSession)
    attempts = store.rows().groupBy("prompt_sha256").agg(
        F.max("attempt").alias("attempt"), F.count("response").alias("replies"))
    open_ = (prompts.join(attempts, "prompt_sha256", "left").where(F.coalesce("replies", F.lit(0)) == 0)
             .groupBy("prompt_sha256").agg(F.min("prompt").alias("prompt"), F.max("attempt").alias("attempt")))
    todo = prompts.select("prompt_sha256").distinct().join(store.answered(), "prompt_sha256", "left_anti").count()
    if not todo:
        return 0

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [outcome(p) for p in part["prompt"]]
            yield pd.DataFrame({
                "prompt_sha256": part["prompt_sha256"], "attempt": part["attempt"].fillna(0).astype("int32") + 1,
                "response": [r for r, _ in found], "error": [e for _, e in found]})

    def outcome(prompt: str) -> tuple[str | None, str | None]:
        try:
            reply = complete(prompt)
        except Exception as exc:  # the provider's failure is data
            return None, f"{type(exc).__name__}: {exc}"
        return (reply, None) if isinstance(reply, str) else (None, f"no text but {type(reply).__name__}")

    parts = -(-todo // calls_per_task)
    store.append(open_.repartition(parts, "prompt_sha256").mapInPandas(run, REPLY_SCHEMA))
    return todo


def annotate_batches(batches: DataFrame, complete: Callable[[str], str], store: ReplyStore,
                     keys: tuple = ("source", "batch"), instructions: str = INSTRUCTIONS,
                     calls_per_task: int = CALLS_PER_TASK) -> DataFrame:
    """One row per batch of ``batches(keys, body)``: ``keys``,
    ``prompt_sha256``, ``response`` and ``error`` (one of the two is null) and
    ``attempts``.

    A second run over the same store calls only prompts that are new, were
    cut off, or failed.  Batches with equal prompts share one call.  A null body
    is an empty one.  No batches: no rows and no call."""
    checkpoint_root(batches.sparkSession)
    prompt = F.concat(F.lit(instructions), F.coalesce("body", F.lit("")))
    prompts = batches.select(*keys, prompt.alias("prompt")).withColumn(
        "prompt_sha256", prompt_digest(F.col("prompt"))).checkpoint(eager=True)
    call_open(prompts.select("prompt_sha256", "prompt"), complete, store, calls_per_task)
    return prompts.select(*keys, "prompt_sha256").join(store.outcomes(), "prompt_sha256", "left").select(
        *keys, "prompt_sha256", "response", "error", "attempts")


# ---------------------------------------------------------------- parsing

_PARSE_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
#: Why a reply is rejected.
NO_REPLY, NO_OBJECT, BROKEN, NO_THEMES = "no reply", "no JSON object", "broken JSON", "no themes"


def parse_responses(df: DataFrame, col: str = "response") -> DataFrame:
    """Parse the reply's JSON; if that fails, parse the outermost
    ``{...}`` block (over several lines) instead; otherwise reject the row.

    Adds ``payload`` (struct), ``status`` (ok | recovered | rejected) and
    ``reason`` (null unless rejected)."""
    whole = F.from_json(F.col(col), PAYLOAD, _PARSE_OPTS)
    block = F.regexp_extract(F.col(col), r"(?s)\{.*\}", 0)
    inner = F.from_json(block, PAYLOAD, _PARSE_OPTS)

    def parsed(p: Column) -> Column:
        return p.isNotNull() & p["_corrupt"].isNull()

    def good(p: Column) -> Column:
        return parsed(p) & p["themes"].isNotNull()

    reason = (F.when(F.coalesce(F.trim(F.col(col)), F.lit("")) == "", NO_REPLY).when(~F.col(col).contains("{"), NO_OBJECT)
              .when(parsed(inner), NO_THEMES).otherwise(BROKEN))
    status = F.when(good(whole), "ok").when(good(inner), "recovered").otherwise("rejected")
    return (df.withColumn("payload", F.when(good(whole), whole).when(good(inner), inner))
            .withColumn("status", status).withColumn("reason", F.when(F.col("status") == "rejected", reason)))


def quarantine(parsed: DataFrame, keys: tuple = ("source", "batch"), col: str = "response") -> DataFrame:
    """The rejected replies as they came: ``keys, reason, response``."""
    return parsed.where("status = 'rejected'").select(*keys, "reason", F.col(col).alias("response"))
