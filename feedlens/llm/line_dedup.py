"""Line dedup: long lines that several documents share stay in one of them.

Each task splits its whole texts into lines, normalises and hashes the long
ones and writes narrow rows (document, line number, hash).  Hashes are counted
with map-side sums; only lines whose hash lies in enough rows are counted again by
distinct documents.  The numbers of the lines that go meet the documents
again, and each text is reassembled by position.  Texts are joined by a
shuffle only if the list of dropped lines is too long to be broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm import text
from feedlens.llm.hot_keys import join_by_key
from feedlens.llm.tables import materialize, prepare_tasks

#: Code points that a normalised line needs to count, and documents that must hold it.
MIN_CHARS = 40
MIN_DOCUMENTS = 5
#: Line numbers that are broadcast at most (some 16 MB); more are joined by shuffle.
BROADCAST_LINES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LINES = "doc_id long, body long, line int, key binary, first boolean"


def long_lines(min_chars: int):
    """Arrow task: ``doc_id, body, text`` -> one row for each line whose key
    (stripped of ``[\\x20\\x09-\\x0D]``, A-Z lower-cased) has ``min_chars`` code
    points; ``first`` marks a key's first line in its row."""

    def split(batches):
        for batch in batches:
            for rows, data, offsets in text.text_chunks(batch):
                yield lines_of(rows, data, offsets)
            text.release_memory()

    def lines_of(rows, data, offsets):
        breaks = data == 10
        starts, ends = _line_spans(breaks, offsets)
        solid = np.flatnonzero(~_SPACE[data])
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        some = high > low
        starts, low, high = starts[some], low[some], high[some]
        begin, end = solid[low], solid[high - 1] + 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        enough = points[end] - points[begin] >= min_chars
        starts, begin, end = starts[enough], begin[enough], end[enough]
        row = np.searchsorted(offsets, starts, "right") - 1
        broken = np.concatenate([[0], np.cumsum(breaks)])
        number = broken[starts] - broken[offsets[row]]
        view = memoryview(text.lower_ascii(data))
        keys = [xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())]
        seen, first = set(), np.zeros(len(keys), bool)
        for j, pair in enumerate(zip(row.tolist(), keys)):
            if pair not in seen:
                seen.add(pair)
                first[j] = True
        at = pa.array(row)
        ids, bodies = (rows.column(rows.schema.get_field_index(c)).take(at) for c in ("doc_id", "body"))
        return pa.RecordBatch.from_arrays(
            [ids, bodies, pa.array(number, pa.int32()), pa.array(keys, pa.binary()), pa.array(first)],
            names=["doc_id", "body", "line", "key", "first"])

    return split


def _line_spans(breaks: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every line that is not empty; none goes over a row's end."""
    first, last = ~breaks, ~breaks
    first[1:] &= breaks[:-1]
    last[:-1] &= breaks[1:]
    filled = offsets[1:] > offsets[:-1]
    begin, end = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begin], last[end] = ~breaks[begin], ~breaks[end]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _reassemble(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    out = []
    for body, gone in zip(texts, dropped):
        if not body.is_valid:
            out.append(None)
            continue
        gone = set(gone.as_py())
        out.append("\n".join(x for j, x in enumerate(body.as_py().split("\n")) if j not in gone))
    return pa.array(out, pa.string())


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``documents(doc_id, text)`` -> one row per input row: ``doc_id``,
    ``text`` (what stays), ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
    A-Z lower-cased.  Keys of at least ``min_chars`` code points that at least
    ``min_documents`` distinct documents hold stay only in the document with the
    largest id, there with all their lines.

    * Null and empty texts are one empty line.  A text that loses all its
      lines becomes empty.
    * Texts are split whole, whatever their length; a key counts once a document.
    * Rows that repeat an id are one document; rows without an id are together
      one document, smaller than any other.  Each input row gives one row.
    * An empty table gives no rows.  Only ``doc_id`` and ``text`` are read.
    """
    prepare_tasks(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Rows of one id may differ in their text, so a line belongs to (id, text).
    rows = rows.withColumn("body", F.xxhash64("text"))
    lines = materialize(rows.mapInArrow(long_lines(min_chars), _LINES), "lines")
    frequent = materialize(
        lines.where("first").groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") >= min_documents),
        "line-keys")
    total = lines.count()
    hits = materialize(join_by_key(lines, frequent, ["key"], "rows", total).drop("rows"), "line-hits")
    held = (hits.where("first").groupBy("key")
            .agg(F.countDistinct(F.struct("doc_id")).alias("documents"), F.max("doc_id").alias("keep_id"),
                 F.count("*").alias("rows")).where(F.col("documents") >= min_documents))
    held = materialize(held.select("key", "keep_id", "rows"), "line-keepers")
    gone = (join_by_key(hits, held, ["key"], "rows", total).where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy(F.col("doc_id").alias("__id"), F.col("body").alias("__body"))
            .agg(F.collect_set("line").alias("__gone")))
    gone = materialize(gone, "line-drops")
    size = gone.agg(F.coalesce(F.sum(F.size("__gone") + 4), F.lit(0))).first()[0]
    if size <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    joined = rows.join(gone, rows["doc_id"].eqNullSafe(gone["__id"]) & (rows["body"] == gone["__body"]), "left")
    # Only texts that lose lines go to Python.
    lost = F.col("__gone").isNotNull()
    kept = F.arrow_udf(_reassemble, "string")(F.when(lost, F.col("text")), F.col("__gone"))
    return joined.withColumn("__kept", kept).select(
        "doc_id", F.coalesce("__kept", "text").alias("text"), line_count("text").alias("n_lines"),
        F.when(lost, F.size("__gone")).otherwise(0).cast("long").alias("n_dropped"))


def line_count(column: str) -> Column:
    """Lines of a text: one more than it has line feeds."""
    return (F.octet_length(column) - F.octet_length(F.replace(column, F.lit("\n"), F.lit(""))) + 1).cast("long")
