"""Document fingerprints by winnowing.

A text is a sequence of words.  Every run of ``k`` words has a hash; of every
``window`` consecutive hashes the smallest is chosen, the rightmost among
equals, and chosen hashes are kept with their positions.  Two texts that share
a run of ``k + window - 1`` words or more share a chosen hash.

Only DataFrame functions are used.  A chosen hash and its position travel as
one long, ``hash * 2**31 + (2**31 - 1 - position)``: the smallest long of a
window is the smallest hash with the rightmost position.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedlens.llm.tables import materialize

GRAM_WORDS = 5
WINDOW = 8
#: Blocks at most; their bounds are one literal of so many longs.
BLOCKS = 2**16
#: Documents in a block that is sorted by one task.
BLOCK_ROWS = 500
_PLACE = 2**31 - 1


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def fingerprint(column: Column, k: int = GRAM_WORDS, window: int = WINDOW) -> Column:
    """Chosen hashes with positions, as packed longs in order of position.

    One to ``k - 1`` words count as one run; a text without words, or null, has
    no hash (an empty array).  Fewer hashes than ``window`` are one window.
    """
    words = F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def windows(grams: Column) -> Column:
        # get() past the end is null, which least() passes over.
        smallest = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(grams) - F.lit(window), F.lit(0))),
            lambda j: F.least(*(F.get(grams, j + F.lit(i)) for i in range(window))))
        return F.array_distinct(smallest)

    def grams(hashes: Column) -> Column:
        packed = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(hashes) - F.lit(k), F.lit(0))),
            lambda i: F.shiftleft(F.xxhash64(*(F.get(hashes, i + F.lit(j)) for j in range(k)))
                                  .bitwiseAND(F.lit(2**32 - 1)), 31)
            .bitwiseOR((F.lit(_PLACE) - i).cast("long")))
        return F.when(F.size(hashes) == 0, F.array().cast("array<long>")).otherwise(_bind(packed, windows))

    return _bind(F.transform(words, lambda w: F.xxhash64(w)), grams)


def hashes(packed: Column) -> Column:
    return F.transform(packed, lambda p: F.shiftright(p, 31))


def positions(packed: Column) -> Column:
    """Word positions of the chosen runs."""
    return F.transform(packed, lambda p: F.lit(_PLACE) - p.bitwiseAND(F.lit(_PLACE)))


def as_text(packed: Column) -> Column:
    """``hash:position`` of every chosen run, in hexadecimal, by position."""
    return F.array_join(F.transform(packed, lambda p: F.concat(
        F.hex(F.shiftright(p, 31)), F.lit(":"), F.hex(F.lit(_PLACE) - p.bitwiseAND(F.lit(_PLACE))))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes; two empty ones are equal."""
    return _bind(F.size(F.array_union(a, b)), lambda n: F.when(n == 0, 1.0).otherwise(
        F.size(F.array_intersect(a, b)) / n))


def _block_of(docs: DataFrame) -> Column:
    """Block of a row's key.  The blocks hold about ``BLOCK_ROWS`` rows each (more
    where that would be over ``BLOCKS`` blocks), however the keys are
    spread, and are numbered by descending key; their bounds are quantiles of the keys."""
    wanted = min(BLOCKS, -(-docs.count() // BLOCK_ROWS))
    if wanted <= 1:
        return F.lit(0)
    shares = [i / wanted for i in range(1, wanted)]
    found = docs.agg(F.percentile_approx("key", shares, max(10000, 10 * wanted))).first()[0]
    bounds = sorted(set(found), reverse=True)
    # One folded literal; a row counts the bounds at or above its key by halving steps.
    listed = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
    steps = F.array(*(F.lit(2**i) for i in reversed(range(len(bounds).bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda below, step: F.when(
        F.get(listed, below + step - 1) >= F.col("key"), below + step).otherwise(below))


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, key, text, ...)`` with struct ``next``: the following row's
    text and packed hashes by descending key, after the last the first.

    A block also gets a copy of the row that follows its last one, so one
    shuffle of the rows is enough.
    """
    rows = docs.withColumn("block", _block_of(docs))
    order = Window.orderBy("block")
    # The row with the largest id of a block also goes to the block before it;
    # the very first also to the last block.
    tops = materialize(rows.groupBy("block").agg(F.max("key").alias("top")), "winnow-blocks")
    last = tops.agg(F.max("block")).first()[0]
    tops = tops.withColumn("before", F.coalesce(F.lag("block").over(order), F.lit(last)))
    tops = materialize(tops.select(F.col("top").alias("top_key"), "before"), "winnow-tops")
    rows = rows.join(F.broadcast(tops), rows["key"] == tops["top_key"], "left").drop("top_key")
    own = F.struct(F.col("block"), F.lit(0).alias("copy"))
    copy = F.struct(F.col("before").alias("block"), F.lit(1).alias("copy"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    rows = rows.select(*docs.columns, "to.block", "to.copy")
    ordered = Window.partitionBy("block").orderBy("copy", F.desc("key"), F.col("doc_id").isNull(), "text")
    return (rows.withColumn("next", F.lead(F.struct("text", "packed")).over(ordered))
            .where("copy = 0").drop("block", "copy"))


def winnow_documents(docs: DataFrame, k: int = GRAM_WORDS, window: int = WINDOW) -> DataFrame:
    """``documents(doc_id, text)`` -> per row ``doc_id, n_chars, text, packed,
    edited, edited_packed, next_packed``: the text's fingerprint, the text
    whose last half is replaced by the start of the next document (descending
    ``doc_id``, after the last the first), that text's fingerprint and the
    next document's.

    * Null text is the empty text; null ids come last in descending order.
    * Rows with the same id follow each other in order of their texts, sorted by
      one task; a single row is its own successor.  An empty table gives no rows.
    * Ids may be any longs, evenly spread or not.  Very long texts are read whole.
    * Only ``doc_id`` and ``text`` are read; other columns may have any name.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Null ids lie just below the smallest id; where there is no smaller long, the order tells them apart.
    low = rows.agg(F.min("doc_id")).first()[0] or 0
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(max(low - 1, -2**63)).cast("long")))
    rows = rows.withColumn("packed", fingerprint(F.col("text"), k, window))
    rows = with_next(rows)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half)))
    return rows.select("doc_id", n.cast("long").alias("n_chars"), "text", "packed", "edited",
                       fingerprint(F.col("edited"), k, window).alias("edited_packed"),
                       F.col("next.packed").alias("next_packed"))
