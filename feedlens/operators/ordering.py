"""Positional numbering without funnelling a group through one task.

``row_number() over (partition by g order by o)`` sends every row of a group
to a single task.  When one group holds a large share of the table (one
channel can hold a third of all reviews) that task is the job.  The helpers
here number rows with a range-partitioned sort instead: every task sorts one
key range, per-task block sizes (one row per task and group) give the
offsets, and the final number is offset + position.  The result equals the
window function row for row.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import checkpoint_root, ship_package


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def number_within(df: DataFrame, by: list[str], order: list, name: str = "rn",
                  partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``by`` group
    in ``order``.

    Every input row gets one number: rows with a NULL id, equal ids or equal
    values are numbered next to each other, none is lost or repeated.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _cols(by) + _cols(order)
    # One range shuffle; each task holds a contiguous, sorted key range.
    # The tagged rows are checkpointed to the shared folder: both branches
    # below then read the same materialised partitions, and a lost executor
    # cannot re-sample the range bounds between them.
    tagged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_task", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    blocks = tagged.groupBy("_task", *by).agg(F.count(F.lit(1)).alias("_n"),
                                              F.min("_pos").alias("_first"))
    w = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        w = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    cond = [tagged["_task"] == blocks["_task"]] + [tagged[c].eqNullSafe(blocks[c]) for c in by]
    joined = tagged.join(blocks, cond).select(
        tagged["*"], blocks["_first"], blocks["_before"])
    return (joined.withColumn(name, F.col("_before") + F.col("_pos") - F.col("_first") + 1)
            .drop("_task", "_pos", "_first", "_before"))


def _sort_key(values: tuple) -> tuple:
    """Python order of ``(group..., order...)`` values, nulls first."""
    return tuple((v is not None, v) for v in values)


def lay_out(df: DataFrame, by: list[str], order: list[Column], size: int,
            each: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str,
            partitions: int | None = None) -> DataFrame:
    """Number the rows of every group and hand them, in order and with their
    numbers, to ``each(batch, numbers)``; all columns of ``df`` move once.

    ``order`` holds ascending expressions (nulls first) of longs or strings.  A
    first pass numbers narrow rows (``by`` and ``order`` alone) and finds where the
    tasks of the second are to start: at every so many rows of a large group, always
    after a multiple of ``size``, so a run of ``size`` rows is never split.  Small
    groups go whole to a task by hash.  There are at most two such bounds a
    task.  In the second pass each row finds its task by bisection.  Rows
    that agree in all of ``by`` and ``order`` have no order among them and stay in one task.

    ``each`` gets the rows in order, a run of ``size`` possibly over two calls;
    a wrapper that must see whole runs can hold rows back (see ``prompts``).
    """
    spark = df.sparkSession
    ship_package(spark)
    keys = [f"__k{j}" for j in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order)))
    numbered = number_within(keyed.select(*by, *keys), by, keys, name="rn")
    counts = numbered.groupBy(*by).agg(F.max("rn").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = max(1, -(-total // (parts * size))) * size
    large = counts.where(F.col("n") > block).select(*(F.col(c).alias(f"__{c}") for c in by))
    in_large = F.lit(True)
    for c in by:
        in_large &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    starts = numbered.join(F.broadcast(large), in_large, "left_semi").where((F.col("rn") - 1) % block == 0)
    # A start whose key another row shares would part rows that have no order.
    same = F.lit(True)
    for c in (*by, *keys):
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    bounds = starts.select(*(F.col(c).alias(f"__{c}") for c in (*by, *keys)), F.col("rn").alias("__rn"))
    alone = (numbered.join(F.broadcast(bounds), same).groupBy(*(f"__{c}" for c in (*by, *keys)), "__rn")
             .agg(F.min("rn").alias("first"), F.count("*").alias("rows")).where("rows = 1 or (__rn = 1 and first = 1)"))
    found = sorted((_sort_key(tuple(r)[:len(by) + len(keys)]), r["__rn"]) for r in alone.drop("first", "rows").collect())
    starts_at, base = [k for k, _ in found], [n - 1 for _, n in found]
    groups = {k[:len(by)] for k in starts_at}

    def task_of(*columns: pa.Array) -> pa.Array:
        out = []
        for values in zip(*(c.to_pylist() for c in columns)):
            key = _sort_key(values)
            out.append(bisect_right(starts_at, key) - 1 if key[:len(by)] in groups else None)
        return pa.array(out, pa.int32())

    def number(batches):
        task = TaskContext.get().partitionId()
        before = base[task] if task < len(base) else 0
        last = None
        for batch in batches:
            group = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in by))) or [()] * batch.num_rows
            numbers = np.empty(batch.num_rows, np.int64)
            for j, g in enumerate(group):
                if last is not None and g != last:
                    before = 0
                before += 1
                numbers[j], last = before, g
            yield each(batch.select([c for c in batch.schema.names if c not in keys]), numbers)

    small = F.pmod(F.xxhash64(F.lit(0), *by), F.lit(parts)).cast("int") + len(base)
    task = F.coalesce(F.arrow_udf(task_of, "int")(*by, *keys), small) if base else small
    return (keyed.withColumn("__task", task).repartitionById(len(base) + parts, F.col("__task")).drop("__task")
            .sortWithinPartitions(*by, *keys).mapInArrow(number, schema))


def top_k_within(df: DataFrame, by: list[str], order: list, k: int,
                 name: str = "rank") -> DataFrame:
    """Rows ranked ``1..k`` inside each group.

    Written as ``row_number() <= k``: Catalyst turns the filter into a
    partial ``WindowGroupLimit`` before the shuffle, so each task sends at
    most k rows per group and a hot group never reaches one task whole.
    """
    w = Window.partitionBy(*by).orderBy(*_cols(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
