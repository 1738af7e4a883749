"""URL filter over a sorted digest array.

Rules are strings ``host/path``.  Their 64-bit xxhash keys are sorted into one
flat file, next to the rule strings.  Every executor fetches the files once
and memory-maps them; a batch of URLs is probed by one vectorised binary
search, and each hit is confirmed on the stored string, so a hash collision
cannot decide.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm.tables import prepare_tasks
from feedlens.session import scratch_path

#: Bytes of rules that one array may hold; more need a larger machine or a split list.
MAX_RULE_BYTES = 1 << 30


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: from there up to ``?``, ``#`` or the end.  Null or no
    ``://``: both empty."""
    rest = F.when(F.instr(F.col(url), "://") > 0,
                  F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one file to the shared folder through its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


class DigestArray:
    """The sorted keys, rule strings and verdicts, ready to be mapped."""

    def __init__(self, spark: SparkSession, rules: list[tuple[str, str, str]]):
        """``rules``: (verdict, host, path) with verdict ``allow`` or ``block``;
        of a repeated host and path the first counts."""
        prepare_tasks(spark)
        unique: dict[str, tuple[str, str, str]] = {}
        for verdict, host, path in rules:
            unique.setdefault(f"{host}{path}", (verdict, host, path))
        found = sorted((xxhash.xxh64_intdigest(_key(h, p)), v, h, p) for v, h, p in unique.values())
        texts = [_key(h, p) for _, _, h, p in found]
        if sum(map(len, texts)) > MAX_RULE_BYTES:
            raise ValueError("the rules exceed MAX_RULE_BYTES")
        self.path_lengths = sorted({len(p) for _, _, _, p in found})
        self.longest_host = max((h.count(".") + 1 for _, _, h, _ in found), default=0)
        ends = np.cumsum([0, *map(len, texts)], dtype=np.int64)
        table = np.empty(len(found), dtype=[("key", "<u8"), ("start", "<i8"), ("end", "<i8"), ("host", "<i4"), ("block", "?")])
        table["key"] = [k for k, *_ in found]
        table["start"], table["end"] = ends[:-1], ends[1:]
        table["host"] = [len(h.encode()) for _, _, h, _ in found]
        table["block"] = [v == "block" for _, v, _, _ in found]
        base = scratch_path(spark, "url-rules")
        self.names = []
        for name, data in (("keys", np.ascontiguousarray(table["key"]).tobytes()), ("rules", table.tobytes()),
                           ("strings", b"".join(texts) or b"\0")):
            name = f"{base.rsplit('/', 1)[1]}-{name}"
            _write(spark, f"{base}/{name}", data)
            spark.sparkContext.addFile(f"{base}/{name}")
            self.names.append(name)
        self.dtype = table.dtype
        self.size = len(found)


def _key(host: str, path: str) -> bytes:
    return f"{host}\n{path}".encode()


def judge(pages: DataFrame, array: DigestArray, default: str = "allow") -> DataFrame:
    """``pages(page_id, url)`` -> ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the URL's path starts with the
    rule's path; the longest fitting rule decides (host and path together,
    then the longer host).  Without one, ``rule`` is null and the verdict is
    ``default``.

    * Null URL or one without ``://``: empty host and path, which no rule
      with a host fits.
    * Repeated pages are each judged; an empty table gives no rows; other
      columns may have any name.
    """
    names, dtype, size = array.names, array.dtype, array.size
    lengths = array.path_lengths

    def probe(batches):
        if size:
            keys = np.memmap(SparkFiles.get(names[0]), "<u8", "r")
            table = np.memmap(SparkFiles.get(names[1]), dtype, "r")
            strings = np.memmap(SparkFiles.get(names[2]), np.uint8, "r")
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            texts, owner = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                for suffix in _suffixes(host, array_labels):
                    for n in lengths:
                        if n <= len(path):
                            texts.append(_key(suffix, path[:n]))
                            owner.append(i)
            best: list[tuple[int, int, str, str] | None] = [None] * len(hosts)
            if size and texts:
                probes = np.fromiter((xxhash.xxh64_intdigest(t) for t in texts), np.uint64, len(texts))
                at = np.searchsorted(keys, probes)
                hit = np.flatnonzero((at < size) & (keys[np.minimum(at, size - 1)] == probes))
                for h in hit.tolist():
                    row = int(at[h])
                    while row < size and keys[row] == probes[h]:
                        rule = table[row]
                        if strings[rule["start"]:rule["end"]].tobytes() == texts[h]:
                            host, path = texts[h].decode().split("\n", 1)
                            found = (len(host) + len(path), len(host), f"{host}{path}",
                                     "block" if rule["block"] else "allow")
                            if best[owner[h]] is None or found > best[owner[h]]:
                                best[owner[h]] = found
                        row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([b and b[2] for b in best], pa.string()),
                 pa.array([b[3] if b else default for b in best], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    array_labels = array.longest_host
    host, path = host_and_path("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url").select(
        "page_id", host.alias("host"), path.alias("path"))
    return rows.mapInArrow(probe, "page_id long, host string, path string, rule string, verdict string")


def _suffixes(host: str, most: int) -> list[str]:
    """The host and the domains above it that have at most ``most`` labels."""
    if not host:
        return []
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(max(0, len(labels) - most), len(labels))]
