"""Prefix trie of conversations.

A prefix is known by the xor of its turns' hashes, each mixed with the turn's
place, so prefixes of any length are a running xor over narrow rows.  A count-min
sketch of all prefixes, added up over the tasks, screens them: an estimate of one
proves that one conversation alone has the prefix, and then all longer ones
of that conversation.  Those tails become nodes where they are; only prefixes
that may be shared are grouped.

What a node needs of its subtree comes from its members in one sum: a
conversation stands for the nodes whose smallest member it is, which are its
prefixes from some depth on.  Children are members that stand for the next
depth, leaves are members that stand for their own last node, and saved tokens
are the turns that a member has above the depth where it starts to stand.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from feedlens.llm import text
from feedlens.llm.hot_keys import join_by_key, running
from feedlens.llm.tables import materialize, prepare_tasks

#: Rows of counters of the sketch, and counters a prefix in each.
SKETCH_ROWS = 4
CELLS_PER_PREFIX = 2
#: Counters of one sketch row at most (a task holds SKETCH_ROWS times as many bytes;
#: packed to bits they are broadcast, 16 MB).  With more prefixes than this, more
#: estimates exceed one and more prefixes are grouped exactly, with the same result.
MAX_CELLS = 2**25
#: Counters of one segment; tasks send and add up the sketch by segments.
SEGMENT_CELLS = 2**16
#: Bytes of joined conversation ids in one block.
ID_BLOCK_BYTES = 1 << 16

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ screening

def _cells(x1: np.ndarray, x2: np.ndarray, cells: int):
    """The counter of each prefix in each sketch row."""
    a, b = x1.view(np.uint64), x2.view(np.uint64) | np.uint64(1)
    for j in range(SKETCH_ROWS):
        h = a + np.uint64(j) * b
        yield ((h ^ (h >> np.uint64(29))) & np.uint64(cells - 1)).astype(np.int64)


def _longs(batch, *names) -> list[np.ndarray]:
    return [np.ascontiguousarray(batch.column(batch.schema.get_field_index(c))) for c in names]


def sketch_size(prefixes: int) -> int:
    cells = SEGMENT_CELLS
    while cells < min(prefixes * CELLS_PER_PREFIX, MAX_CELLS):
        cells *= 2
    return cells


def repeated_cells(prefixes: DataFrame, cells: int) -> np.ndarray:
    """The count-min sketch of ``prefixes(x1, x2)``, as what the screening needs
    of it: for each sketch row the packed bits of counters above one."""

    def count(batches):
        counters = np.zeros((SKETCH_ROWS, cells), np.uint8)
        for batch in batches:
            for j, at in enumerate(_cells(*_longs(batch, "x1", "x2"), cells)):
                places, times = np.unique(at, return_counts=True)
                counters[j, places] = np.minimum(counters[j, places] + np.minimum(times, 2), 2)
        for j in range(SKETCH_ROWS):
            for s in range(0, cells, SEGMENT_CELLS):
                part = counters[j, s:s + SEGMENT_CELLS]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j * (cells // SEGMENT_CELLS) + s // SEGMENT_CELLS], pa.int32()),
                         pa.array([part.tobytes()])], names=["segment", "counters"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, part in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(part, np.uint8)
                sums[s] = np.minimum(sums[s] + part, 2) if s in sums else part
        for s, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(part > 1).tobytes()])], names=["segment", "bits"])

    parts = (prefixes.select("x1", "x2").mapInArrow(count, "segment int, counters binary")
             .repartition("segment").mapInArrow(add, "segment int, bits binary"))
    table = np.zeros(SKETCH_ROWS * cells // 8, np.uint8)
    for row in parts.toLocalIterator():
        at = row.segment * SEGMENT_CELLS // 8
        table[at:at + SEGMENT_CELLS // 8] = np.frombuffer(row.bits, np.uint8)
    return table.reshape(SKETCH_ROWS, cells // 8)


def proven_single(spark, table: np.ndarray) -> Column:
    """True where the estimate (the least of the counters) is one."""
    shared = spark.sparkContext.broadcast(table)

    def probe(x1: pa.Array, x2: pa.Array) -> pa.Array:
        bits = shared.value
        single = np.zeros(len(x1), bool)
        for j, at in enumerate(_cells(np.ascontiguousarray(x1), np.ascontiguousarray(x2), bits.shape[1] * 8)):
            single |= ((bits[j][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1) == 0
        return pa.array(single)

    return F.arrow_udf(probe, BooleanType())("x1", "x2")


# ------------------------------------------------------------------ ids of a node

def _id_blocks(batches):
    """Sorted ``x1, x2, conv_id`` -> the ids of each node joined to blocks of text."""
    node, ids, size = None, [], 0

    def block():
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]]), pa.array([node[1]]), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])],
            names=["x1", "x2", "first_id", "ids"])

    for batch in batches:
        for x1, x2, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and ((x1, x2) != node or size >= ID_BLOCK_BYTES):
                yield block()
                ids, size = [], 0
            node = x1, x2
            ids.append(conv)
            size += len(str(conv)) + 1
    if ids:
        yield block()


def _hash_blocks(batches):
    """Sorted blocks -> SHA-256 of each node's joined ids, one block at a time."""
    node, state = None, None

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([node[0]]), pa.array([node[1]]), pa.array([state.hexdigest()])], names=["x1", "x2", "sha"])

    for batch in batches:
        for x1, x2, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if (x1, x2) != node:
                if node is not None:
                    yield done()
                node, state = (x1, x2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if node is not None:
        yield done()


def joined_ids_sha256(members: DataFrame) -> DataFrame:
    """``x1, x2, conv_id`` (once each) -> ``x1, x2, sha``: the SHA-256 of a node's
    decimal ids, ascending and joined by commas.

    A node's ids are sorted and joined in many tasks; only the blocks of text,
    one for some thousand ids, meet in one task, which hashes them one by one."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (members.repartitionByRange(parts, "x1", "x2", "conv_id").sortWithinPartitions("x1", "x2", "conv_id")
              .select("x1", "x2", "conv_id").mapInArrow(_id_blocks, "x1 long, x2 long, first_id long, ids string"))
    return (blocks.repartition("x1", "x2").sortWithinPartitions("x1", "x2", "first_id")
            .mapInArrow(_hash_blocks, "x1 long, x2 long, sha string"))


# ------------------------------------------------------------------ the trie

def turn_rows(conversations: DataFrame) -> DataFrame:
    """Narrow rows of the turns: ``conv_id, turn, e1, e2, bytes``; two hashes
    stand for role and text."""
    role, body = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(F.lit(1), role, body).alias("e1"), F.xxhash64(F.lit(2), role, body).alias("e2"),
        F.octet_length(body).cast("long").alias("bytes"))


def rebuilt(conversations: DataFrame, heads_of: int = 5, head_turns: int = 9) -> tuple[DataFrame, DataFrame]:
    """(sequences ``conv_id, depth, e1, e2, bytes``, conversations ``conv_id, n_turns``).

    Conversation c gets the first h turns of conversation c - c % ``heads_of``
    (all if fewer), then its own after its first h; h is the unsigned crc32 of
    its decimal id modulo ``head_turns``."""
    turns = materialize(turn_rows(conversations), "trie-turns")
    own = running(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("e1"), F.col("e2")], name="trie-own")
    own = materialize(own.drop("turn"), "trie-positions")
    # The last position is the number of turns; max adds up before it is sent.
    sizes = materialize(own.groupBy("conv_id").agg(F.max("position").alias("n_own")), "trie-sizes")
    base_of = F.col("conv_id") - F.col("conv_id") % heads_of
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = (sizes.withColumns({"base": base_of, "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % head_turns})
             .join(bases, "base", "left")
             .withColumn("n_head", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
             .withColumn("n_turns", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0).cast("long"))))
    convs = materialize(convs.select("conv_id", "base", "h", "n_own", "n_head", "n_turns"), "trie-conversations")
    # At most head_turns - 1 rows of a base, for at most 2 * heads_of - 1 conversations.
    heads = (own.where(F.col("position") < head_turns).withColumnRenamed("conv_id", "base")
             .join(convs.select("conv_id", "base", "h"), "base").where(F.col("position") <= F.col("h"))
             .withColumnRenamed("position", "depth"))
    tails = (join_by_key(own, convs.select("conv_id", "h", "n_own", "n_head"), ["conv_id"], "n_own", own.count())
             .where(F.col("position") > F.col("h"))
             .withColumn("depth", F.col("position") - F.col("h") + F.col("n_head")))
    cols = ["conv_id", "depth", "e1", "e2", "bytes"]
    return heads.select(cols).unionByName(tails.select(cols)), convs.select("conv_id", "n_turns")


def prefix_nodes(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``sequences(conv_id, depth, e1, e2, bytes)`` (depths 1, 2, ...
    of each conversation) over all ``convs(conv_id, n_turns)``: one row a node
    with ``x1, x2`` (its key), ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256`` and ``screened`` (made from a tail).

    Without conversations there is no node; a conversation without turns
    belongs to the root.  Depth is bounded by nothing but the data.
    """
    spark = sequences.sparkSession
    prepare_tasks(spark)
    zero = F.lit(0).cast("long")
    turns = materialize(sequences.select(
        "conv_id", "depth", "bytes", F.xxhash64(F.lit(1), "depth", "e1", "e2").alias("x1"),
        F.xxhash64(F.lit(2), "depth", "e1", "e2").alias("x2")), "trie-sequences")
    prefixes = running(turns, "conv_id", [F.col("depth")], ("x1", "x2"), ("bytes",), name="trie-running")
    prefixes = materialize(prefixes.select("conv_id", "depth", "bytes", F.col("run_x1").alias("x1"),
                                           F.col("run_x2").alias("x2"), F.col("run_bytes").alias("upto")), "trie-prefixes")
    n_prefixes = prefixes.count()
    table = repeated_cells(prefixes, sketch_size(n_prefixes))

    # cut: the first depth proven to be single; one past the end if there is none.
    cuts = (prefixes.where(proven_single(spark, table)).groupBy("conv_id").agg(F.min("depth").alias("cut")))
    convs = convs.join(cuts, "conv_id", "left").withColumn("cut", F.coalesce("cut", F.col("n_turns") + 1))
    convs = materialize(convs.withColumn("rows", F.col("n_turns") + 1), "trie-cuts")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("bytes"), zero.alias("x1"), zero.alias("x2"),
                         zero.alias("upto"), "n_turns", "cut")
    known = join_by_key(prefixes, convs, ["conv_id"], "rows", n_prefixes).drop("rows")
    tails = known.where(F.col("depth") >= F.col("cut"))
    shared = materialize(known.where(F.col("depth") < F.col("cut")).unionByName(roots), "trie-shared")
    n_shared = shared.count()

    nodes = materialize(shared.groupBy("x1", "x2").agg(
        F.min("conv_id").alias("first"), F.count("*").alias("n_convs"), F.max("n_turns").alias("deepest")), "trie-nodes")
    members = materialize(join_by_key(shared, nodes, ["x1", "x2"], "n_convs", n_shared), "trie-members")

    # start: the depth from which a conversation stands for its prefixes.
    ahead = F.when(F.col("first") != F.col("conv_id"), F.col("depth"))
    stands = members.groupBy("conv_id").agg(
        F.coalesce(F.min(F.when(F.col("first") == F.col("conv_id"), F.col("depth"))), F.max("cut")).alias("start"),
        F.max_by("first", ahead).alias("parent"), F.coalesce(F.max_by("upto", ahead), zero).alias("before"),
        F.max(F.when((F.col("depth") == F.col("n_turns")) & (F.col("deepest") > F.col("n_turns")), 1)).alias("goes_on"),
        F.max("cut").alias("rows"))
    stands = materialize(stands, "trie-stands")
    part = join_by_key(members, stands, ["conv_id"], "rows", n_shared)
    ends_here = F.col("depth") == F.col("n_turns")
    child = (F.col("n_turns") > F.col("depth")) & (F.col("start") <= F.col("depth") + 1)
    leaf = (F.col("start") <= F.col("n_turns")) & F.col("goes_on").isNull()
    saved = F.when(F.col("depth") < F.col("start"), F.col("before") - F.col("upto") + F.col("bytes")).otherwise(zero)
    parent = F.when(F.col("depth") > F.col("start"), F.col("conv_id")).otherwise(F.col("parent"))
    grouped = part.groupBy("x1", "x2").agg(
        F.min("first").alias("conv_id"), F.min("depth").alias("depth"),
        F.max(F.when(F.col("first") == F.col("conv_id"), parent)).alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"), F.count_if(child).alias("n_children"), F.count_if(leaf).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"), F.count_if(ends_here).alias("n_ends"),
        F.max(F.when(ends_here, F.col("conv_id"))).alias("end"))
    grouped = materialize(grouped, "trie-grouped")
    # Most nodes end no conversation or one; the ids of the others are joined.
    many = materialize(grouped.where("n_ends > 1").select("x1", "x2", "n_ends"), "trie-ends")
    joined = joined_ids_sha256(join_by_key(
        shared.where(ends_here).select("x1", "x2", "conv_id"), many, ["x1", "x2"], "n_ends", n_shared))
    ends = F.when(F.col("n_ends") > 1, F.col("sha")).when(F.col("n_ends") == 1, sha256_of("end")).otherwise(F.lit(_EMPTY_SHA))
    cols = ["x1", "x2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    top = grouped.join(joined, ["x1", "x2"], "left").select(*cols, ends.alias("ends_sha256"), F.lit(False).alias("screened"))

    # A tail's first node hangs below the smallest member of the last shared one.
    at_cut = members.where(F.col("depth") == F.col("cut") - 1).select("conv_id", F.col("first").alias("above"))
    first = tails.where(F.col("depth") == F.col("cut")).join(at_cut, "conv_id").withColumn("parent_conv_id", F.col("above"))
    rest = tails.where(F.col("depth") > F.col("cut")).withColumn("parent_conv_id", F.col("conv_id"))
    one = F.lit(1).cast("long")
    alone = first.drop("above").unionByName(rest).select(
        "x1", "x2", "conv_id", "depth", "parent_conv_id", one.alias("n_convs"),
        F.when(ends_here, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends_here, sha256_of("conv_id")).otherwise(F.lit(_EMPTY_SHA)).alias("ends_sha256"),
        F.lit(True).alias("screened"))
    return top.unionByName(alone)


def sha256_of(column: str) -> Column:
    return F.sha2(F.col(column).cast("string").cast("binary"), 256)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` -> the trie of the rebuilt
    conversations (see ``rebuilt`` and ``prefix_nodes``).

    * Turns are ordered by ``turn`` (null first); turns of one number are ordered by a hash of role
      and text, so equal rows stay side by side and the order is the same in every run.
    * Null role or text is empty.  Rows without ``conv_id`` belong to no
      conversation and are left out.  Repeated rows are turns of their own.
    * Texts are hashed and counted whole.  An empty table gives no node.
    * Only the four columns are read; others may have any name.
    """
    return prefix_nodes(*rebuilt(conversations))
