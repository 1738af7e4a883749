"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots.  Bytes are aggregated per
slot, and a small versioned table maps slots to shards.  Rebalancing edits
that table: whole slots move, and a record's slot never changes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from feedlens.llm.tables import materialize

#: Virtual slots; fixed for the life of a dataset.
VIRTUAL_SLOTS = 8192
#: Shards are balanced when the largest exceeds the mean by no more than this.
TOLERANCE = 0.01
#: The same for the shards of ``shard_documents``.
DOCUMENT_TOLERANCE = 0.001

_MAP = StructType([StructField("version", IntegerType()), StructField("virtual_slot", IntegerType()),
                   StructField("shard", IntegerType())])


def virtual_slot(n_slots: int = VIRTUAL_SLOTS) -> F.Column:
    """Slot of a row: a hash of its id and text size, so that rows with a null
    or repeated id spread as well."""
    return F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(n_slots)).cast("int")


def sized(docs: DataFrame, n_slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """``(doc_id, size, text_crc32, virtual_slot)``: size is the text's UTF-8
    bytes (null: none) plus 1."""
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return rows.withColumn("virtual_slot", virtual_slot(n_slots))


def slot_sizes(rows: DataFrame) -> dict[int, int]:
    """Bytes in each slot; at most the fixed number of slots reach the driver."""
    return {r.virtual_slot: r.bytes for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()}


def initial_map(sizes: dict[int, int], shards: int, n_slots: int = VIRTUAL_SLOTS) -> dict[int, int]:
    """Largest slot first, each to the shard with the fewest bytes."""
    heap = [(0, 0, s) for s in range(shards)]
    placed: dict[int, int] = {}
    for slot in sorted(range(n_slots), key=lambda v: (-sizes.get(v, 0), v)):
        total, held, shard = heapq.heappop(heap)
        placed[slot] = shard
        heapq.heappush(heap, (total + sizes.get(slot, 0), held + 1, shard))
    return placed


def rebalanced(current: dict[int, int], sizes: dict[int, int], shards: int,
               tolerance: float = TOLERANCE) -> dict[int, int]:
    """``current`` edited for ``shards`` shards: slots of shards that are gone
    and single slots of the fullest shard move to the emptiest, until all are
    within the tolerance or no move narrows the gap.  A shard that can give no
    slot, as one with a single very large row, leaves its turn to the next.  Other slots stay."""
    placed = dict(current)
    totals = {s: 0 for s in range(shards)}
    held: dict[int, set[int]] = {s: set() for s in range(shards)}
    homeless = []
    for slot, shard in placed.items():
        if shard < shards:
            totals[shard] += sizes.get(slot, 0)
            held[shard].add(slot)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda v: (-sizes.get(v, 0), v)):
        to = min(totals, key=lambda s: (totals[s], s))
        placed[slot] = to
        totals[to] += sizes.get(slot, 0)
        held[to].add(slot)
    mean = sum(totals.values()) / shards
    giving = set(totals)
    while giving:
        high = max(giving, key=lambda s: (totals[s], -s))
        low = min(totals, key=lambda s: (totals[s], s))
        gap = totals[high] - totals[low]
        if totals[high] <= mean * (1 + tolerance) and totals[low] >= mean * (1 - tolerance):
            return placed
        fitting = [v for v in held[high] if 0 < sizes.get(v, 0) < gap]
        if not fitting:
            giving.remove(high)
            continue
        slot = max(fitting, key=lambda v: (min(sizes[v], gap - sizes[v]), -v))
        placed[slot] = low
        held[high].remove(slot), held[low].add(slot)
        totals[high] -= sizes[slot]
        totals[low] += sizes[slot]
    return placed


class SlotMapStore:
    """Versions of the slot map, one Parquet folder each, under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def save(self, version: int, placed: dict[int, int]) -> None:
        """Write a version; an existing version is never overwritten."""
        rows = [(version, slot, shard) for slot, shard in sorted(placed.items())]
        self.spark.createDataFrame(rows, _MAP).coalesce(1).write.parquet(f"{self.path}/version={version:08d}/map")

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema(_MAP).parquet(f"{self.path}/version={version:08d}/map")

    def latest(self) -> int:
        """The last version saved; 0 in an empty store."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(root):
            return 0
        names = [f.getPath().getName() for f in files.listStatus(root)]
        return max((int(n.split("=")[1]) for n in names if n.startswith("version=")), default=0)

    def placed(self, version: int) -> dict[int, int]:
        return {r.virtual_slot: r.shard for r in self.load(version).collect()}


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows with the shard of their virtual slot; the map has a fixed size."""
    return rows.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, a row's place in its shard, without gaps from 0: rows of
    earlier virtual slots of the shard plus the place in its own."""
    counts = rows.groupBy("shard", "virtual_slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("virtual_slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("place", F.row_number().over(own)).join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", (F.col("start") + F.col("place") - 1).cast("long")).drop("start", "place"))


def shard_documents(docs: DataFrame, shards: int, store: SlotMapStore, n_slots: int = VIRTUAL_SLOTS,
                    shards_before: int | None = None) -> DataFrame:
    """``documents(doc_id, text)`` -> one row per input row: ``doc_id``,
    ``size``, ``text_crc32``, ``virtual_slot``, ``shard``, ``slot``; shard
    sizes in bytes are near equal.

    The store's last version of the map is edited for ``shards`` shards and the
    present sizes, and saved as the next one.  An empty store starts with a
    version for ``shards_before`` shards (``shards`` if not given).

    * Null text has size 1 and the checksum of the empty text.
    * Null and repeated ids are rows like any other; rows equal in id, size
      and checksum share a slot.  An empty table gives no rows.
    * A very long text is one row of its slot; slots of the same size are
      placed in order of their number.
    * Only ``doc_id`` and ``text`` are read; other columns may have any name.
    """
    rows = materialize(sized(docs, n_slots), "shard-rows")
    sizes = slot_sizes(rows)
    version = store.latest()
    if not version:
        version = 1
        store.save(version, initial_map(sizes, shards_before or shards, n_slots))
    store.save(version + 1, rebalanced(store.placed(version), sizes, shards, DOCUMENT_TOLERANCE))
    return numbered(assign(rows, store.load(version + 1)))
