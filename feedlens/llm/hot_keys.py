"""Joins whose keys may be hot, and running totals along groups of any size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructType

from feedlens.llm import text
from feedlens.llm.tables import materialize, prepare_tasks

#: Keys that are broadcast at most.  A key counts as hot when it holds more
#: than one in so many of all rows, so there are never more of them.
HOT_KEYS = 100_000


def join_by_key(rows: DataFrame, values: DataFrame, keys: list[str], weight: str, total: int,
                how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row a key.

    ``values[weight]`` is the number of ``rows`` that a key holds, ``total`` the
    number of all rows.  The hot keys are broadcast, so that their rows stay
    where they are; the others, each with a small share of the rows, are
    joined by a shuffle.  Null keys are equal.  ``how`` is inner or left.
    """
    names = [f"__key_{k}" for k in keys]
    named = values.withColumnsRenamed(dict(zip(keys, names)))

    def same(right: DataFrame) -> Column:
        found = F.lit(True)
        for k, n in zip(keys, names):
            found &= rows[k].eqNullSafe(right[n])
        return found

    def matched(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
        return left.join(right, same(right), kind).drop(*names)

    hot_test = F.col(weight) * HOT_KEYS > total
    hot, cold = named.where(hot_test), named.where(~hot_test)
    others = rows.join(F.broadcast(hot.select(names)), same(hot), "left_anti")
    return matched(rows, F.broadcast(hot), "inner").unionByName(matched(others, cold, how))


def running(df: DataFrame, key: str, order: list[Column], xors: tuple[str, ...] = (),
            sums: tuple[str, ...] = (), name: str = "running") -> DataFrame:
    """``df`` with ``position`` (1, 2, ... inside the rows of one ``key``, by
    ``order``) and, for each column of ``xors`` and ``sums``, ``run_<column>``:
    the xor or sum over the key's rows up to this one.

    The rows are dealt by ranges of (key, order), so a key with a third of all
    rows is spread over many tasks.  Each task adds up its own range; what a
    key that goes over several tasks has gathered before a task is then added
    from one row a task.  ``key`` and the added columns are longs; null keys
    are one group.  ``df`` should be narrow and written: Spark reads it twice
    to find the ranges.
    """
    spark = df.sparkSession
    prepare_tasks(spark)
    runs = ["position", *(f"run_{c}" for c in (*xors, *sums))]
    schema = StructType([*df.schema.fields])
    for column in runs:
        schema = schema.add(column, LongType())
    schema = schema.add("_task", IntegerType()).add("_head", BooleanType()).add("_last", BooleanType())

    def scan(batches):
        task = TaskContext.get().partitionId()
        before, head_open, held = None, True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield flagged(*held, False)
            column = batch.column(batch.schema.get_field_index(key))
            nulls = np.asarray(column.is_null())
            values = np.asarray(column.fill_null(0))
            new = np.ones(len(values), bool)
            new[1:] = (values[1:] != values[:-1]) | (nulls[1:] != nulls[:-1])
            goes_on = before is not None and before[0] == (values[0], nulls[0])
            if before is None:
                head_open = True
            elif not goes_on:
                head_open = False
            starts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            out = [np.arange(1, len(values) + 1) - starts[group]]
            for c in xors:
                x = np.asarray(batch.column(batch.schema.get_field_index(c)))
                total = np.bitwise_xor.accumulate(x)
                base = np.concatenate([[0], total])[starts]
                out.append(total ^ base[group])
            for c in sums:
                x = np.asarray(batch.column(batch.schema.get_field_index(c)))
                total = np.cumsum(x)
                base = np.concatenate([[0], total])[starts]
                out.append(total - base[group])
            if goes_on:
                first = group == 0
                for j, gathered in enumerate(before[1]):
                    out[j][first] = out[j][first] ^ gathered if 0 < j <= len(xors) else out[j][first] + gathered
            head = (group == 0) & head_open
            head_open = bool(head[-1])
            before = (values[-1], nulls[-1]), [o[-1] for o in out]
            held = batch, out, head
        if held is not None:
            yield flagged(*held, True)
        text.release_memory()


    def flagged(batch, out, head, at_end):
        last = np.zeros(len(head), bool)
        last[-1] = at_end
        task = np.full(len(head), TaskContext.get().partitionId(), np.int32)
        columns = [*batch.columns, *(pa.array(o.astype(np.int64)) for o in out), pa.array(task), pa.array(head), pa.array(last)]
        return pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(key).asc_nulls_first(), *order]
    tagged = materialize(df.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(scan, schema), name)

    # One row a task: what its last key has gathered in it and in the tasks before.
    so_far = Window.partitionBy(key).orderBy("_task")
    ends = tagged.where("_last").select(
        "_task", key, F.sum("position").over(so_far).alias("position"),
        *(F.bit_xor(f"run_{c}").over(so_far).alias(f"run_{c}") for c in xors),
        *(F.sum(f"run_{c}").over(so_far).alias(f"run_{c}") for c in sums))
    previous = Window.orderBy("_task")
    gathered = ends.select("_task", *(F.lag(c).over(previous).alias(f"_before_{c}") for c in (key, *runs)))
    heads = tagged.where("_head and position = 1").select("_task", key)
    carried = (heads.join(F.broadcast(gathered), "_task")
               .where(F.col(key).eqNullSafe(F.col(f"_before_{key}")) & F.col("_before_position").isNotNull())
               .select(F.col("_task").alias("_carry_task"), *(f"_before_{c}" for c in runs)))
    joined = tagged.join(F.broadcast(carried), F.col("_head") & (F.col("_task") == F.col("_carry_task")), "left")

    def whole(c: str) -> Column:
        more = F.coalesce(F.col(f"_before_{c}"), F.lit(0).cast("long"))
        return (F.col(c).bitwiseXOR(more) if c in {f"run_{x}" for x in xors} else F.col(c) + more).alias(c)

    return joined.select(*df.columns, *map(whole, runs))
