"""Interpolated modified Kneser-Ney models over byte symbols.

A text is read as a sequence of symbols (classes of UTF-8 bytes) and scored by
its runs of ``LONG`` symbols, of which a corpus may hold up to 2**30: what a
model gathers grows with the corpus.  Tasks count n-grams by sorting, with sums
on the map side; the counts are summed, joined with the counts of their histories
and suffixes and turned into probabilities by Spark joins sharded on the n-gram.
For scoring the most frequent n-grams (``HOT`` at most) are broadcast, and a
text's other n-grams are joined with the model by a shuffle on the n-gram.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm import text
from feedlens.llm.tables import materialize

SYMBOLS = 32
ORDER = 4
GRAMS = SYMBOLS ** ORDER
#: Symbols of the n-grams that texts are scored by.
LONG = 6
#: N-grams that scoring tasks get by broadcast, the most frequent ones.
HOT = 1 << 18
#: Different n-grams that a counting task holds before it hands them on.
HELD = 1 << 18
#: Sums over joined n-grams are made in whole numbers of which this is one, so
#: they are the same in any order.
UNIT = 1 << 24

# Symbols: 0 digit, 1-26 letters a-z, 27 white space (also before the text and
# after it), 28 capital letter A-Z, 29 comma or full stop, 30 byte of a
# non-ASCII character, 31 any other byte.
_SYMBOL = np.full(256, 31, np.int32)
_SYMBOL[48:58] = 0
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[[9, 10, 11, 12, 13, 32]] = 27
_SYMBOL[65:91] = 28
_SYMBOL[[44, 46]] = 29
_SYMBOL[128:] = 30
EDGE = 27
#: The same with capitals as small letters.
_SYMBOL_CASELESS = _SYMBOL.copy()
_SYMBOL_CASELESS[65:91] = np.arange(1, 27)


def text_grams(data: np.ndarray, offsets: np.ndarray, caseless: bool = False,
               order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of every row, one for each byte and one for the end of the
    text, and each row's range.  An empty text has the end alone."""
    pad = order  # order - 1 edges before the text and one after it
    rows = len(offsets) - 1
    padded = np.full(len(data) + pad * rows, EDGE, np.int32)
    shift = np.repeat(np.arange(rows) * pad + pad - 1, np.diff(offsets))
    padded[np.arange(len(data)) + shift] = (_SYMBOL_CASELESS if caseless else _SYMBOL)[data]
    grams = np.zeros(max(len(padded) - order + 1, 0), np.int32 if SYMBOLS ** order < 2**31 else np.int64)
    for j in range(order):
        grams = grams * SYMBOLS + padded[j:j + len(grams)]
    # Grams that start in one row's padding and end in the next row's are dropped.
    ranges = offsets + np.arange(rows + 1)
    keep = np.arange(ranges[-1]) + np.repeat(np.arange(rows) * (order - 1), np.diff(ranges))
    return grams[keep], ranges


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes of all parts and the sums of their counts."""
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(place, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def count_grams(docs: DataFrame, classes: list[str], caseless: bool = False, order: int = ORDER) -> DataFrame:
    """Counts of each n-gram: ``(gram, <class>...)`` with one long column for
    each boolean column in ``classes``; a row counts where its column is true.
    ``docs`` has ``text`` and the classes.  A task holds some ``HELD`` different
    n-grams at a time, however many its texts have."""
    def batch_of(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.where(codes >> c & 1, counts, 0)) for c in range(len(classes))]
        return pa.RecordBatch.from_arrays([pa.array(codes >> len(classes)), *columns], names=["gram", *classes])

    def count(batches):
        parts, held = [], 0
        for batch in batches:
            for rows, data, offsets in text.text_chunks(batch):
                grams, ranges = text_grams(data, offsets, caseless, order)
                # A code is an n-gram with a bit for each class of its row.
                mask = np.zeros(rows.num_rows, np.int64)
                for c, name in enumerate(classes):
                    chosen = rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
                    mask |= chosen.astype(np.int64) << c
                of_row = np.repeat(mask, np.diff(ranges))
                codes = ((grams.astype(np.int64) << len(classes)) | of_row)[of_row > 0]
                parts.append(np.unique(codes, return_counts=True))
                held += len(parts[-1][0])
                if held > 2 * HELD:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > HELD:
                        yield batch_of(*parts[0])
                        parts, held = [], 0
        if parts:
            yield batch_of(*_merged(parts))
        text.release_memory()

    schema = ", ".join(f"{c} long" for c in ["gram", *classes])
    flags = [F.coalesce(F.col(c).cast("boolean"), F.lit(False)).alias(c) for c in classes]
    counted = docs.select("text", *flags).mapInArrow(count, schema)
    return counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in classes))


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the counts of counts."""
    n = counts.agg(*(F.count(F.when(F.col("a") == i, 1)) for i in (1, 2, 3, 4))).first()
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1))


def _interpolate(wanted: DataFrame, counts: DataFrame, lower: DataFrame | None, length: int,
                 whole: bool = False) -> DataFrame:
    """Probability of each wanted n-gram of ``length`` symbols given its
    history: its discounted count by a join on the n-gram, the history's total
    and freed mass by a join on the history, and the lower order's probability
    by a join on the suffix; with ``whole``, ``lower`` is of the same order and is
    joined on the n-gram itself."""
    d1, d2, d3 = _discounts(counts)
    counts = counts.withColumn("d", F.when(F.col("a") == 1, d1).when(F.col("a") == 2, d2).otherwise(d3))
    histories = counts.groupBy(F.expr(f"gram div {SYMBOLS}").alias("history")).agg(
        F.sum("a").alias("total"), F.sum("d").alias("freed"))
    rows = (wanted.withColumn("history", F.expr(f"gram div {SYMBOLS}"))
            .join(counts, "gram", "left").join(histories, "history", "left"))
    if lower is None:
        rows = rows.withColumn("p_lower", F.lit(1.0 / SYMBOLS))
    else:
        suffix = F.col("gram") if whole else F.col("gram") % SYMBOLS ** (length - 1)
        rows = rows.withColumn("suffix", suffix).join(
            lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), "suffix")
    own = F.coalesce(F.greatest(F.col("a") - F.col("d"), F.lit(0.0)), F.lit(0.0))
    return rows.select("gram", F.when(F.col("total").isNull(), F.col("p_lower")).otherwise(
        (own + F.col("freed") * F.col("p_lower")) / F.col("total")).alias("p"))


def backoff_probabilities(counts: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, p)`` of order ``order - 1`` for every suffix of the wanted
    n-grams, from the continuation counts of ``counts(gram, a)``."""
    levels, level = [], counts.where("a > 0").select("gram", "a")
    needs, need = [], wanted.select("gram")
    for length in range(order - 1, 0, -1):
        suffix = F.col("gram") % SYMBOLS ** length
        level = materialize(level.groupBy(suffix.alias("gram")).agg(F.count("*").alias("a")), "lm-continuations")
        need = need.select(suffix.alias("gram")).distinct()
        levels.append((length, level)), needs.append(need)
    lower = None
    for (length, level), need in zip(reversed(levels), reversed(needs)):
        lower = materialize(_interpolate(need, level, lower, length), "lm-probabilities")
    return lower


def top_probabilities(counts: DataFrame, wanted: DataFrame, lower: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, p)`` of order ``order`` for the wanted n-grams, from
    ``counts(gram, a)`` and the given lower order."""
    return _interpolate(wanted.select("gram"), counts.where("a > 0").select("gram", "a"), lower, order)


def class_probabilities(counts: DataFrame, shared: DataFrame, order: int) -> DataFrame:
    """``(gram, p)`` for the n-grams of ``shared(gram, p)``, a model of that order:
    what ``counts(gram, a)`` of one class leave free goes to the shared model."""
    return _interpolate(shared.select("gram"), counts.where("a > 0").select("gram", "a"), shared, order, whole=True)


def gram_scores(spark, table: np.ndarray, caseless: bool = False, column: str = "text",
                model: Column | None = None) -> Column:
    """Struct of the sum of the table's values over a text's n-grams and their
    number.  ``table`` may hold the tables of several models, one after another;
    ``model`` then says which of them scores a row."""
    shared = spark.sparkContext.broadcast(table)

    @F.arrow_udf("total double, grams long")
    def score(values: pa.Array, models: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([values, models], names=["text", "model"])
        totals, sizes = [np.zeros(0)], [np.zeros(0, np.int64)]
        for rows, data, offsets in text.text_chunks(batch):
            grams, ranges = text_grams(data, offsets, caseless)
            if len(shared.value) > GRAMS:
                grams = grams + np.repeat(rows.column(1).to_numpy() * GRAMS, np.diff(ranges))
            totals.append(text.row_sums(shared.value[grams], ranges))
            sizes.append(np.diff(ranges))
        text.release_memory()
        return pa.StructArray.from_arrays([pa.array(np.concatenate(totals)), pa.array(np.concatenate(sizes))],
                                          names=["total", "grams"])

    return score(F.col(column), F.lit(0) if model is None else model.cast("int"))


def _hot(values: DataFrame, names: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The most frequent n-grams of ``values(gram, n, <names>...)``, in order, and
    their values: those of all powers of two of ``n`` that together have at most
    ``HOT``."""
    power = F.floor(F.log2("n")).alias("power")
    found = sorted(values.groupBy(power).count().collect(), reverse=True)  # 63 rows at most
    least, total = 63, 0
    for row in found:
        total += row["count"]
        if total > HOT:
            break
        least = row.power
    rows = values.where(F.floor(F.log2("n")) >= least).orderBy("gram").select("gram", *names).toArrow()
    return rows["gram"].to_numpy(), [rows[c].to_numpy().astype(np.float64) for c in names]


def score_texts(rows: DataFrame, values: DataFrame, names: list[str], caseless: bool = False,
                order: int = LONG) -> DataFrame:
    """``rows(text, ...)`` without the text, with the sum over the text's n-grams
    of each value in ``values(gram, n, <names>...)`` and the number ``grams`` of its
    n-grams.  ``n`` is the n-gram's count; n-grams without a value add nothing.

    Frequent n-grams are added while the text is read.  The others are written,
    once a text with their number, joined with ``values`` on the n-gram and added
    up by row; no text is moved."""
    spark = rows.sparkSession
    keys, tables = _hot(values, names)
    shared = spark.sparkContext.broadcast((keys, tables))
    kept = [c for c in rows.columns if c != "text"]

    def scan(batches):
        keys, tables = shared.value
        for batch in batches:
            for part, data, offsets in text.text_chunks(batch):
                grams, ranges = text_grams(data, offsets, caseless, order)
                grams = grams.astype(np.int64)
                at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
                hit = keys[at] == grams if len(keys) else np.zeros(len(grams), bool)
                sums = [text.row_sums(np.where(hit, t[at], 0) if len(keys) else np.zeros(len(grams)), ranges)
                        for t in tables]
                row = np.repeat(np.arange(part.num_rows), np.diff(ranges))[~hit]
                others, counts = np.unique(row * SYMBOLS ** order + grams[~hit], return_counts=True)
                ends = pa.array(np.searchsorted(others, np.arange(part.num_rows + 1) * SYMBOLS ** order).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64)))
                         for x in (others % SYMBOLS ** order, counts)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(part.schema.get_field_index(c)) for c in kept), *map(pa.array, sums),
                     pa.array(np.diff(ranges)), *lists], names=[*kept, *names, "grams", "_grams", "_counts"])
        text.release_memory()

    kinds = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), *(f"{c} double" for c in names)])
    read = rows.select(*kept, "text").mapInArrow(scan, f"{kinds}, grams long, _grams array<long>, _counts array<long>")
    read = materialize(read.withColumn("_row", F.monotonically_increasing_id()), "lm-read")
    shared.destroy()
    other = read.select("_row", F.explode(F.arrays_zip("_grams", "_counts")).alias("o")).select(
        "_row", F.col("o._grams").alias("gram"), F.col("o._counts").alias("times"))
    added = other.join(values.select("gram", *names), "gram").groupBy(F.col("_row").alias("_added")).agg(
        *((F.sum(F.col("times") * F.round(F.col(c) * UNIT).cast("long")) / UNIT).alias(f"_{c}") for c in names))
    return read.join(added, F.col("_row") == F.col("_added"), "left").select(
        *kept, *((F.col(c) + F.coalesce(f"_{c}", F.lit(0.0))).alias(c) for c in names), "grams")
