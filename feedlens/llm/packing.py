"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most a bin's capacity and packed into
bins; a bin never holds two pieces of one source or of one cluster of equal
texts.  Pieces are dealt into packs of bounded size by a hash, and each pack
is packed by one task: open bins are kept in order of what is left in them
and carry a bitmap of their sources and one of their clusters; from the first
bin that is large enough the search goes on until a compatible one is found,
which is the tightest.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.tables import materialize, prepare_tasks

CAPACITY = 2048
#: Pieces in a pack, on average; a pack is packed in one task's memory.
PACK_PIECES = 4096
#: Bins of a pack are numbered below this.
BIN_RANGE = 2**32


def best_fit(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece ``(tokens, source, cluster)``, in order."""
    source_bit: dict[object, int] = {}
    cluster_bit: dict[object, int] = {}
    open_bins: list[tuple[int, int]] = []  # (left, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for tokens, source, cluster in pieces:
        s = 1 << source_bit.setdefault(source, len(source_bit))
        c = 1 << cluster_bit.setdefault(cluster, len(cluster_bit))
        at = bisect_left(open_bins, (tokens, -1))
        while at < len(open_bins) and (sources[open_bins[at][1]] & s or clusters[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            left, number = open_bins.pop(at)
        else:
            left, number = capacity, len(sources)
            sources.append(0), clusters.append(0)
        placed.append((number, capacity - left))
        sources[number] |= s
        clusters[number] |= c
        if left > tokens:
            insort(open_bins, (left - tokens, number))
    return placed


def pack(docs: DataFrame, capacity: int = CAPACITY, pack_pieces: int = PACK_PIECES) -> DataFrame:
    """``docs(doc_id, source, cluster, tokens, copy)`` -> one row per piece:
    ``doc_id, copy, piece, start, tokens, bin, bin_offset, source, cluster``.

    * A document longer than the capacity gives full pieces and a rest.
    * A document without tokens gives one piece of 0 tokens, so no row is lost.
    * ``copy`` tells repeated rows of a document apart.  Null ids, sources and
      clusters are values like any other: two null sources conflict.
    * An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare_tasks(spark)
    full = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1)).cast("int")
    pieces = (docs.select("doc_id", "copy", "source", "cluster", F.col("tokens").alias("whole"),
                          F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"))
              .withColumn("start", F.col("piece").cast("long") * capacity)
              .withColumn("tokens", F.least(F.col("whole") - F.col("start"), F.lit(capacity)).cast("long")).drop("whole"))
    pieces = materialize(pieces, "pack-pieces")
    packs = max(1, -(-pieces.count() // pack_pieces))
    pieces = pieces.withColumn("pack", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(packs)))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["tokens", "doc_id", "copy", "piece"], ascending=[False, True, True, True],
                                  kind="stable").reset_index(drop=True)
        known = frame[["source", "cluster"]].astype(object).where(frame[["source", "cluster"]].notna(), None)
        placed = best_fit(list(zip(frame["tokens"].tolist(), known["source"].tolist(), known["cluster"].tolist())), capacity)
        frame["bin"] = [int(frame["pack"].iloc[0]) * BIN_RANGE + number for number, _ in placed]
        frame["bin_offset"] = [offset for _, offset in placed]
        return frame[["doc_id", "copy", "piece", "start", "tokens", "bin", "bin_offset", "source", "cluster"]]

    kind = dict(docs.dtypes)
    return pieces.groupBy("pack").applyInPandas(one, (
        f"doc_id long, copy long, piece int, start long, tokens long, bin long, bin_offset long, "
        f"source {kind['source']}, cluster {kind['cluster']}"))
