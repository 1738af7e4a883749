"""Exact dedup with two passes over a Bloom filter.

Pass one sets, for every row's digest, ``HASHES`` bits of a filter that
remembers for each bit whether it was set once or more than once.  Equal
digests set all their bits at least twice, so a row with any bit set only
once is surely alone.  Pass two probes the filter: rows that are surely
alone pass straight through, and only the others shuffle to be compared on
the whole digest.  The filter is sized from the row count up to
``MAX_BITS``; beyond that more single rows are compared than needed, with the
same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from feedlens.llm import text
from feedlens.llm.tables import bounded, materialize, prepare_tasks

#: Bits of the filter for each row and bits set by each digest.
BITS_PER_ROW = 16
HASHES = 4
#: The filter is broadcast and never larger than 2**29 bits, 64 MB.
MAX_BITS = 2**29
#: Bits of one segment; tasks send and merge the filter by segments.
SEGMENT_BITS = 2**16


def text_digest(column: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased, in UTF-8; null is empty."""
    return F.arrow_udf(_digests, "binary")(F.col(column))


def _digests(values: pa.Array) -> pa.Array:
    data, offsets = text.utf8(values)
    data = memoryview(text.lower_ascii(data))
    digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    del data
    text.release_memory()
    return pa.array(digests, pa.binary())


def _bits(digests: pa.Array, size: int) -> np.ndarray:
    """Row by row the filter bits of 32-byte digests, ``HASHES`` each."""
    data, _ = text.utf8(digests)
    words = np.ascontiguousarray(data).view("<u8").reshape(-1, 4)
    return (words[:, :HASHES] & np.uint64(size - 1)).astype(np.int64)


def repeated_bits(digests: DataFrame, rows: int) -> np.ndarray:
    """The filter of ``digests(digest)``: a byte array whose bits are those
    set at least twice."""
    size = SEGMENT_BITS
    while size < min(rows * BITS_PER_ROW, MAX_BITS):
        size *= 2

    def fill(batches):
        once, twice = np.zeros(size, bool), np.zeros(size, bool)
        for batch in batches:
            bits = np.sort(_bits(batch.column(0), size).ravel())
            again = np.concatenate([bits[1:] == bits[:-1], [False]]) if len(bits) else bits.astype(bool)
            twice[bits[again]] = True
            twice[bits[once[bits]]] = True
            once[bits] = True
        for s in range(0, size, SEGMENT_BITS):
            set_bits = np.flatnonzero(once[s:s + SEGMENT_BITS]).astype("<u2")
            if len(set_bits):
                many = np.flatnonzero(twice[s:s + SEGMENT_BITS]).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s // SEGMENT_BITS], pa.int32()), pa.array([set_bits.tobytes()]),
                     pa.array([many.tobytes()])], names=["segment", "once", "twice"])

    def merge(batches):
        state: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                once, twice = state.setdefault(
                    s, (np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)))
                a, b = np.frombuffer(a, "<u2"), np.frombuffer(b, "<u2")
                twice[a[once[a]]] = True
                twice[b] = True
                once[a] = True
        for s, (_, twice) in state.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(twice).tobytes()])], names=["segment", "bits"])

    parts = (digests.select("digest").mapInArrow(fill, "segment int, once binary, twice binary")
             .repartition("segment").mapInArrow(merge, "segment int, bits binary"))
    table = np.zeros(size // 8, np.uint8)
    for row in parts.toLocalIterator():
        at = row.segment * SEGMENT_BITS // 8
        table[at:at + SEGMENT_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return table


def maybe_repeated(spark, bits: np.ndarray, digest: Column) -> Column:
    """True where every bit of the digest was set at least twice."""
    shared = spark.sparkContext.broadcast(bits)
    return F.arrow_udf(lambda values: _probe(values, shared.value), BooleanType())(digest)


def digest_and_suspicion(spark, bits: np.ndarray, column: str = "text") -> Column:
    """Struct of a text's digest and whether it may be repeated, in one pass."""
    shared = spark.sparkContext.broadcast(bits)

    def judge(values: pa.Array) -> pa.Array:
        digests = _digests(values)
        return pa.StructArray.from_arrays([digests, _probe(digests, shared.value)], names=["digest", "suspect"])

    return F.arrow_udf(judge, "digest binary, suspect boolean")(F.col(column))


def _probe(digests: pa.Array, table: np.ndarray) -> pa.Array:
    at = _bits(digests, len(table) * 8)
    return pa.array(((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` -> one row per input row: ``doc_id``,
    ``keep_id`` (largest id among equal texts), ``group_size``, ``kept`` and
    ``text_sha256``.

    * Texts are equal when identical after lower-casing A-Z; null is empty.
    * Rows that repeat both the text and the largest id: exactly one is kept.
    * Null ids count as smaller than any id; a group of null ids alone keeps
      one row and its ``keep_id`` is null.  An empty table gives no rows.
    * Only ``doc_id`` and ``text`` are read; other columns may have any name.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    rows = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
        .withColumn("row", F.monotonically_increasing_id()), "dedup-digests")
    bits = repeated_bits(rows, rows.count())
    judged = rows.withColumn("suspect", maybe_repeated(spark, bits, F.col("digest")))
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    alone = judged.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha)
    suspects = judged.where("suspect").drop("suspect")
    # One row per repeated digest, added up before it is sent; written, so that
    # it is broadcast where it is small and Spark splits a hot digest otherwise.
    groups = materialize(
        suspects.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size"))
        .where("group_size > 1"), "dedup-groups")
    compared = suspects.join(bounded(groups), "digest", "left").select(
        "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep.row"), F.lit(True)).alias("kept"), sha)
    return alone.unionByName(compared)


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the
    largest id; all columns are kept as they are.  Rows that are surely alone
    are not shuffled."""
    spark = docs.sparkSession
    prepare_tasks(spark)
    columns = docs.columns
    digests = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest")),
                          "dedup-digests")
    bits = repeated_bits(digests, digests.count())
    rows = docs.withColumn("__judged", digest_and_suspicion(spark, bits))
    rows = rows.withColumns({"__digest": F.col("__judged.digest"), "__suspect": F.col("__judged.suspect")}).drop("__judged")
    groups = materialize(
        digests.where(maybe_repeated(spark, bits, F.col("digest")))
        .groupBy(F.col("digest").alias("__digest")).agg(
            F.max("doc_id").alias("__keep"), F.count("*").alias("__size"))
        .where("__size > 1"), "dedup-groups")
    found = rows.where("__suspect").join(bounded(groups), "__digest", "left")
    found = found.where(F.col("__size").isNull() | F.col("doc_id").cast("long").eqNullSafe(F.col("__keep")))
    # More than one row of a digest is left only where rows repeat the id, too.
    return rows.where("not __suspect").select(columns).unionByName(
        found.dropDuplicates(["__digest"]).select(columns))
