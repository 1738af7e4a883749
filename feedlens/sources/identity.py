"""Identity of reviews.

Stores name their reviews with strings of their own, or not at all, and a crawl
may land the same review twice.  A review's key is its channel with the
native id, or with a hash of date, title and text, and the number of the
occurrence, so that every landed row has a key that no other row has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.operators.ordering import number_within
from feedlens.session import scratch_path

CONTENT = ("date", "title", "text")
#: A key is hot when it holds more than one in so many of all rows: there are
#: never more hot keys than this, so they may be broadcast.
HOT_KEYS = 100_000


def base_key(native: str = "review_id", content: tuple = CONTENT) -> Column:
    """``source/id``, or ``source/#hash`` for a review without an id.

    The hash is over the length and value of each part, so no two different
    lists of parts give the same input; a null part counts as empty."""
    def part(c: str) -> Column:
        value = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.concat(F.length(value).cast("string"), F.lit(":"), value)

    native_id = F.nullif(F.col(native).cast("string"), F.lit(""))
    hashed = F.concat(F.lit("#"), F.sha2(F.concat(*map(part, content)).cast("binary"), 256))
    return F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce(native_id, hashed))


def with_review_key(df: DataFrame, native: str = "review_id", content: tuple = CONTENT,
                    keep: tuple | None = None) -> DataFrame:
    """``df`` with ``review_key``: the base key, ``#`` and the occurrence 1, 2, ...

    n rows give n different keys, and the same rows give the same keys however
    they are dealt over files: rows of one base key are numbered by a hash of
    all their columns, and rows that agree in that, too, are equal.  Null or
    empty ids count as none.  Base keys are counted first, with map-side sums; only rows
    whose base key is repeated are sorted, and a base key with a third of all
    rows is spread over many tasks by a further random part of the sort key.

    ``keep`` names the columns of ``df`` that the result has (default: all).  The keys
    are of all columns either way, but no other column is written or moved.
    """
    spark = df.sparkSession
    kept = list(keep or df.columns)

    def written(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    # Read and hashed once; all that follows reads the written rows.
    keyed = written(df.select(*kept, base_key(native, content).alias("_base"), F.xxhash64(*df.columns).alias("_content")),
                    "review-keys")
    repeated = written(keyed.groupBy("_base").agg(F.count("*").alias("_rows")).where("_rows > 1")
                       .select(F.col("_base").alias("_again"), "_rows"), "repeated-keys")
    total = keyed.count()
    is_hot = F.col("_rows") * HOT_KEYS > total
    hot, cold = repeated.where(is_hot), repeated.where(~is_hot)
    same = F.col("_base") == F.col("_again")
    others = keyed.join(F.broadcast(hot), same, "left_anti").join(cold, same, "left")
    single = others.where("_again is null").withColumn("_n", F.lit(1).cast("long"))
    many = keyed.join(F.broadcast(hot), same, "left_semi").unionByName(
        others.where("_again is not null").select(keyed.columns))
    many = many.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    numbered = number_within(many, ["_base"], ["_content", "_spread"], name="_n")
    cols = [*kept, F.concat("_base", F.lit("#"), F.col("_n").cast("string")).alias("review_key")]
    return single.select(*cols).unionByName(numbered.select(*cols))
