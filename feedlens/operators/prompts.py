"""Prompt batches for an external language model, and the row sets of its
payloads (W2, L2, L4, T5, T6, T9).

Every review is sent, in batches of at most ``PACK_SIZE``; nothing is
sampled away.  The calls and their replies are in ``operators.replies``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.dates import iso_string
from feedlens.operators.ordering import lay_out, number_within, top_k_within
from feedlens.operators.privacy import clean_reviews

PACK_SIZE = 35
HEAD_SIZE = 35
PREVIEW_ROWS = 3


def newest_first() -> list[Column]:
    return [F.col("date").desc(), F.col("review_id")]

INSTRUCTIONS = (
    "Group the customer reviews below into 3 to 5 themes, assign every review "
    "(by its number) to exactly one theme, answer the product questions with "
    "evidence, and reply with one JSON object with the keys themes, clustering, "
    "question_answers and weekly_note.\n---\n")


def _order_keys() -> list[Column]:
    """``newest_first`` as ascending longs with nulls first: the newest date
    is the smallest key, a missing one the largest."""
    age = F.coalesce(-F.unix_micros(F.col("date").cast("timestamp")), F.lit(2**63 - 1))
    return [age, F.col("review_id")]


def number_reviews(df: DataFrame, by=("source",), name: str = "rn") -> DataFrame:
    """``review_id, by, date`` and the 1-based position per group, newest
    first (ties by review id).

    Only these narrow columns are dealt, sorted and written
    (``ordering.number_within``); no text is read or moved."""
    narrow = df.select("review_id", *(c for c in by if c != "review_id"), "date")
    return number_within(narrow, list(by), newest_first(), name=name)


LINE_START = "Review #"


def prompt_line(index: Column) -> Column:
    """T5: one review block of the prompt.

    ``Review #i [Source: s | Rating: r/5 | Title: t | Date: d]:`` newline,
    the quoted text, a blank line.  Rating is left out when NULL or 0, the
    title when NULL or empty.  Input must already be masked."""
    return F.concat(F.lit(LINE_START), index.cast("string"), line_rest())


def line_rest() -> Column:
    """What follows the number in a prompt line."""
    rating = F.when(F.coalesce(F.col("rating"), F.lit(0)) != 0,
                    F.concat(F.lit(" | Rating: "), F.col("rating").cast("string"), F.lit("/5")))
    title = F.when(F.length("title") > 0, F.concat(F.lit(" | Title: "), F.col("title")))
    return F.concat(F.lit(" [Source: "), F.col("source"),
                    F.coalesce(rating, F.lit("")), F.coalesce(title, F.lit("")),
                    F.lit(" | Date: "), F.coalesce(iso_string("date"), F.lit("")),
                    F.lit(']:\n"'), F.coalesce(F.col("text"), F.lit("")), F.lit('"\n\n'))


def _lines(rest: pa.Array, numbers: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(LINE_START, pc.cast(pa.array(numbers), pa.string()), rest, "")


def _types(df: DataFrame, columns) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _line_rows(clean: DataFrame, by: list[str]) -> DataFrame:
    return clean.select("review_id", *by, "date", line_rest().alias("rest"))


def prompt_lines(clean: DataFrame, by=("source",), name: str = "rn") -> DataFrame:
    """T5 for all reviews: ``review_id, by, rn, line``.

    ``clean`` holds masked reviews with unique ids (``sources.identity`` gives
    them); reviews that share id and date are numbered in any order.  Each
    text moves once, to the task that holds its number (``ordering.lay_out``)."""
    by = list(by)

    def each(batch: pa.RecordBatch, numbers: np.ndarray) -> pa.RecordBatch:
        rest = batch.column(batch.schema.get_field_index("rest"))
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("review_id", *by)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(numbers), _lines(rest, numbers)], names=["review_id", *by, name, "line"])

    rows = _line_rows(clean, by)
    schema = f"{_types(rows, ['review_id', *by])}, `{name}` long, line string"
    return lay_out(rows, by, _order_keys(), PACK_SIZE, each, schema)


def assign_batches(numbered: DataFrame, size: int = PACK_SIZE) -> DataFrame:
    """Batch number and position inside the batch (1..size)."""
    batch = F.floor((F.col("rn") - 1) / F.lit(size)).cast("bigint")
    return (numbered.withColumn("batch", batch)
            .withColumn("review_index", (F.col("rn") - F.col("batch") * size).cast("int")))


def pack_prompts(clean: DataFrame, size: int = PACK_SIZE, by=("source",)) -> DataFrame:
    """One prompt body per (group, batch) of at most ``size`` reviews,
    in numbering order: ``by, batch, n_reviews, body``.

    Texts move once: the tasks of ``ordering.lay_out`` start where batches
    start, so each batch is joined in the task that holds its rows.  What
    is said of ids at ``prompt_lines`` holds here, too."""
    by = list(by)

    def each(batch: pa.RecordBatch, numbers: np.ndarray) -> pa.RecordBatch:
        """Rows with their batch number and the line that numbers them inside it."""
        rest = batch.column(batch.schema.get_field_index("rest"))
        kept = [batch.column(batch.schema.get_field_index(c)) for c in by]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array((numbers - 1) // size), _lines(rest, (numbers - 1) % size + 1)], names=[*by, "batch", "line"])

    def join(batches):
        """Join the lines of equal (group, batch), which come one after another."""
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = list(zip(*(rows[c].to_pylist() for c in (*by, "batch"))))
            cut = len(keys)
            while cut and keys[cut - 1] == keys[-1]:
                cut -= 1
            if cut:
                yield joined(rows.slice(0, cut), keys[:cut])
            held = rows.slice(cut)
        if held is not None and held.num_rows:
            yield joined(held, list(zip(*(held[c].to_pylist() for c in (*by, "batch")))))

    def joined(rows: pa.Table, keys: list[tuple]) -> pa.RecordBatch:
        starts = [j for j in range(len(keys)) if not j or keys[j] != keys[j - 1]]
        offsets = np.array([*starts, len(keys)], np.int32)
        lines = pa.ListArray.from_arrays(pa.array(offsets), rows["line"].combine_chunks())
        kept = [rows[c].combine_chunks().take(pa.array(starts)) for c in (*by, "batch")]
        return pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(offsets).astype(np.int64)), pc.binary_join(lines, "")],
                                          names=[*by, "batch", "n_reviews", "body"])

    rows = _line_rows(clean, by)
    groups = f"{_types(rows, by)}, " if by else ""
    lines = lay_out(rows, by, _order_keys(), size, each, f"{groups}batch long, line string")
    return lines.mapInArrow(join, f"{groups}batch long, n_reviews long, body string")


def subsample_head(union: DataFrame, n: int = HEAD_SIZE) -> DataFrame:
    """L2 as the reference does it: the first ``n`` rows in list order
    (play store, app store, social; newest first inside).  TakeOrdered
    keeps n rows per task before the merge."""
    order = [F.col("priority"), *newest_first()]
    head = union.orderBy(*order).limit(n)
    # n rows at most: a global window over them is bounded.
    return head.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def subsample_fair(union: DataFrame, k: int = 7) -> DataFrame:
    """L2, fair variant: the newest k rows of every source."""
    return top_k_within(union, ["source"], newest_first(), k, name="rank")


def subsample(union: DataFrame, n: int, k: int) -> DataFrame:
    """L2, both variants from one read of the union: ``variant`` 'head' with
    the first ``n`` rows in list order, 'fair' with the newest ``k`` of every
    source.  Either is among the newest ``max(n, k)`` of a (priority, source),
    so only that many rows of each reach the two final ranks."""
    near = top_k_within(union, ["priority", "source"], newest_first(), max(n, k), name="near")
    order = [F.col("priority"), *newest_first()]
    ranked = near.withColumns({
        "head": F.row_number().over(Window.orderBy(*order)),
        "fair": F.row_number().over(Window.partitionBy("source").orderBy(*newest_first()))})
    picks = F.array(F.struct(F.lit("head").alias("variant"), F.col("head").alias("rank"), (F.col("head") <= n).alias("in")),
                    F.struct(F.lit("fair").alias("variant"), F.col("fair").alias("rank"), (F.col("fair") <= k).alias("in")))
    return (ranked.withColumn("pick", F.explode(picks)).where("pick.in")
            .select(*union.columns, "pick.variant", "pick.rank"))


def preview_head(df: DataFrame, k: int = PREVIEW_ROWS) -> DataFrame:
    """L4: the first k reviews (by id), masked."""
    return clean_reviews(df.orderBy("review_id").limit(k))


def explode_payload(parsed: DataFrame, keys=("source", "batch")) -> dict[str, DataFrame]:
    """Flatten parsed payloads to their row sets (0-based ``pos`` keeps
    the order given in the payload)."""
    from feedlens.session import checkpoint_root

    keys = list(keys)
    # Six row sets read the payload, and each would otherwise parse every
    # response again (twice: strict, then the recovered block).  The parsed
    # payloads are written once to the shared folder and read six times.
    checkpoint_root(parsed.sparkSession)
    ok = parsed.where(F.col("payload").isNotNull()).select(*keys, "payload").checkpoint(eager=True)
    p = F.col("payload")

    def rows(arr, *names):
        # posexplode_outer + filter: with the inner form Catalyst would
        # push a non-empty filter, i.e. a second JSON parse, below.
        return (ok.select(*keys, F.posexplode_outer(arr).alias("pos", *names))
                .where(F.col("pos").isNotNull()))

    themes = rows(p["themes"], "t").select(
        *keys, "pos", F.col("t.id").alias("id"), F.col("t.name").alias("name"),
        F.col("t.description").alias("description"))
    assignments = rows(p["clustering"], "c").select(
        *keys, "pos", F.col("c.review_index").alias("review_index"), F.col("c.theme_id").alias("theme_id"))
    answers = (ok.select(*keys, F.explode_outer(p["question_answers"]).alias("question_key", "answer"))
               .where(F.col("question_key").isNotNull()))
    note = p["weekly_note"]
    top = rows(note["top_themes"], "t").select(
        *keys, "pos", F.col("t.rank").alias("rank"), F.col("t.name").alias("name"),
        F.col("t.rationale").alias("rationale"))
    quotes = rows(note["user_quotes"], "quote")
    actions = rows(note["action_ideas"], "action")
    return {"themes": themes, "assignments": assignments, "answers": answers,
            "top_themes": top, "quotes": quotes, "actions": actions}


def payload_rows(parts: dict[str, DataFrame], keys=("source", "batch")) -> DataFrame:
    """All parts of ``explode_payload`` as one long table
    ``kind, keys, pos, key, value``."""
    keys = list(keys)

    def shape(df, kind, pos, key, value):
        return df.select(F.lit(kind).alias("kind"), *keys, pos.cast("bigint").alias("pos"),
                         key.cast("string").alias("key"), value.cast("string").alias("value"))

    out = shape(parts["themes"], "theme", F.col("pos"), F.col("id"), F.col("name"))
    out = out.unionByName(shape(parts["assignments"], "assignment", F.col("pos"),
                                F.col("review_index"), F.col("theme_id")))
    out = out.unionByName(shape(parts["answers"], "answer", F.lit(None), F.col("question_key"),
                                F.col("answer")))
    out = out.unionByName(shape(parts["top_themes"], "top_theme", F.col("pos"), F.col("rank"),
                                F.col("name")))
    out = out.unionByName(shape(parts["quotes"], "quote", F.col("pos"), F.lit(None), F.col("quote")))
    out = out.unionByName(shape(parts["actions"], "action", F.col("pos"), F.lit(None), F.col("action")))
    return out

