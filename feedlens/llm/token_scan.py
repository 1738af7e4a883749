"""Token counts of documents in flat, unindexed token files.

A token file is a run of little-endian 32-bit ids in which every document ends
with a separator id; nothing says where documents start.  Files are read in
blocks by different tasks.  Each block finds its separators with one
vectorised comparison, and a prefix scan over the blocks of a file - the last
separator before a block and the number of documents ended before it -
stitches documents that cross block boundaries.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.llm import text
from feedlens.llm.tables import materialize, prepare_tasks
from feedlens.session import scratch_path

SEPARATOR = 0
TOKEN_BYTES = 4
#: Bytes of a block; a task holds one block at a time.
BLOCK_BYTES = 8 << 20
#: Blocks that a task reads, one after the other, once there are more than shuffle partitions.
BLOCKS_PER_TASK = 32


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, folder: str) -> DataFrame:
    """Write word ids of ``docs(doc_id, text)`` as token files, one per task,
    and return ``(file, ordinal, doc_id)``: which document is where.

    An id is a hash of the word, never the separator.  A task that is run
    again writes another file; only files that the result names count.  The
    result is written, so files and table belong together.
    """
    prepare_tasks(docs.sparkSession)

    def write(batches):
        name, stream, ordinal = f"tokens-{uuid.uuid4().hex}.bin", None, 0
        try:
            for batch in batches:
                for rows, data, offsets in text.text_chunks(batch):
                    if stream is None:
                        fs, path = _file_system(folder)
                        fs.create_dir(path, recursive=True)
                        stream = fs.open_output_stream(f"{path}/{name}")
                    starts, ends, ranges = text.word_spans(data, offsets)
                    ids = (text.word_hashes(data, starts, ends) >> np.uint64(33)).astype("<u4") + np.uint32(1)
                    n = rows.num_rows
                    flat = np.full(len(ids) + n, SEPARATOR, "<u4")
                    flat[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(ranges))] = ids
                    stream.write(flat.tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n)),
                         rows.column(0).cast(pa.int64())], names=["file", "ordinal", "doc_id"])
                    ordinal += n
        finally:
            if stream is not None:
                stream.close()

    rows = docs.select("doc_id", "text").mapInArrow(write, "file string, ordinal long, doc_id long")
    return materialize(rows, "token-manifest")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, file, length)`` of the files in a folder; contents are not read."""
    found = spark.read.format("binaryFile").load(folder).select("path", "length")
    return found.withColumn("file", F.element_at(F.split("path", "/"), -1))


def separator_scan(files: DataFrame, block_bytes: int = BLOCK_BYTES, separator: int = SEPARATOR) -> DataFrame:
    """``files(path, file, length)`` -> one row per document: ``file, ordinal,
    first_token, n_tokens, ended``.

    * The separator belongs to no document.  Two separators in a row hold an
      empty document.
    * Tokens after a file's last separator are a last document that has not
      ended.  An empty file has no document; a length that is not a multiple
      of the token width raises.
    """
    if block_bytes % TOKEN_BYTES:
        raise ValueError("a block must hold whole tokens")
    prepare_tasks(files.sparkSession)
    blocks = materialize(
        files.where("length > 0").select("path", "file", "length", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias("begin")), "token-blocks")

    def scan(batches):
        for batch in batches:
            for path, name, length, begin in zip(*(c.to_pylist() for c in batch.columns)):
                if length % TOKEN_BYTES:
                    raise ValueError(f"{path} does not hold whole tokens")
                fs, inner = _file_system(path)
                with fs.open_input_file(inner) as source:
                    tokens = np.frombuffer(source.read_at(min(block_bytes, length - begin), begin), "<u4")
                ends = np.flatnonzero(tokens == separator) + begin // TOKEN_BYTES
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([begin // TOKEN_BYTES]), pa.array([length // TOKEN_BYTES]),
                     pa.array([ends], pa.list_(pa.int64()))], names=["file", "begin", "length", "ends"])

    count = blocks.count()
    tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // BLOCKS_PER_TASK))
    dealt = blocks.repartition(max(1, min(count, tasks)), "path", "begin")
    found = materialize(dealt.mapInArrow(scan, "file string, begin long, length long, ends array<long>"), "token-ends")

    before = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.select("file", "begin", "length", F.size("ends").alias("k"), F.array_max("ends").alias("last"))
    stitched = sums.select("file", "begin", F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"),
                           F.coalesce(F.sum("k").over(before), F.lit(0)).alias("ended_before"))
    rows = found.join(stitched, ["file", "begin"])
    previous = F.concat(F.array(F.col("previous").cast("long")), F.col("ends"))
    ended = (rows.select("file", "ended_before", F.posexplode(F.arrays_zip(
                F.slice(previous, 1, F.size("ends")).alias("p"), F.col("ends").alias("e"))).alias("i", "d"))
             .select("file", (F.col("ended_before") + F.col("i")).alias("ordinal"), (F.col("d.p") + 1).alias("first_token"),
                     (F.col("d.e") - F.col("d.p") - 1).alias("n_tokens"), F.lit(True).alias("ended")))
    rest = (sums.groupBy("file").agg(F.max("length").alias("length"), F.sum("k").alias("ordinal"),
                                     F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
            .where("last < length - 1")
            .select("file", "ordinal", (F.col("last") + 1).alias("first_token"),
                    (F.col("length") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("ended")))
    return ended.unionByName(rest)


def count_tokens(docs: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` -> ``doc_id, n_tokens, file, ordinal,
    first_token``: documents are written as token files, which are then
    scanned for separators.

    * Null or empty text has 0 tokens.  Repeated rows are each counted.
    * An empty table gives no rows; other columns may have any name.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), folder)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, n_tokens long, file string, ordinal long, first_token long")
    named = manifest.select("file").distinct()
    files = token_files(spark, folder).join(named, "file", "left_semi")
    found = separator_scan(files)
    return manifest.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "first_token")
