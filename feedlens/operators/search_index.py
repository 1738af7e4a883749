"""Text search through trigram postings.

The index holds, for each three-character run of the reviews' folded texts and
titles, lists of the reviews that have it.  From a pattern come the runs that every match must contain, as
a formula of ands and ors; the postings give the reviews that fulfil it, and only those
are read and tested with the pattern itself.  A pattern from which nothing
follows is answered by a scan, so the result is always that of the scan.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators.search import search_reviews
from feedlens.session import checkpoint_root, ship_package

GRAM = 3
#: Folders of postings (by run) and of reviews (by id).
GRAM_FOLDERS, ROW_FOLDERS = 64, 256
#: Bytes of text whose postings are listed together; one longer text is listed alone.
LISTED_BYTES = 1 << 22

Formula = tuple | str | None  # ("and" | "or", parts), a run, or None: nothing follows


# ---------------------------------------------------------------- patterns

def _both(kind: str, parts: list[Formula]) -> Formula:
    if kind == "or" and None in parts:
        return None
    parts = [p for p in dict.fromkeys(parts) if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _runs(literal: str) -> list[Formula]:
    return [literal[j:j + GRAM] for j in range(len(literal) - GRAM + 1)]


def _needed(parsed) -> Formula:
    """What every match of a parsed sequence contains."""
    found: list[Formula] = []
    literal = ""
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL" and value < 128:
            literal += chr(value).lower()
            continue
        found += _runs(literal)
        literal = ""
        if name == "SUBPATTERN":
            found.append(_needed(value[-1]))
        elif name == "BRANCH":
            found.append(_both("or", [_needed(branch) for branch in value[1]]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and value[0] > 0:
            found.append(_needed(value[2]))
        elif name == "ATOMIC_GROUP":
            found.append(_needed(value))
    return _both("and", found + _runs(literal))


#: Only what both regex dialects read alike is looked into: letters, digits, blanks and
#: some punctuation, groups, choices, simple classes and repeats, and the classes \\w \\d \\s \\b.
_COMMON = re.compile(r"(?:[A-Za-z0-9 ,;:!@%&=~'\"/<>_-]|\.|\((?!\?)|\(\?:|\)|\||\^|\$|[*+?]|\\[wdsbWDSB.()|*+?^$\[\]{}\\]"
                     r"|\[\^?[A-Za-z0-9_.,;:!@ -]+\]|\{\d+(?:,\d*)?\})*\Z")


def needed_runs(pattern: str) -> Formula:
    """The runs that a case-insensitive match of ``pattern`` must contain, or
    None if none are certain (any other construct than the common ones)."""
    if not _COMMON.match(pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            parsed = re._parser.parse(pattern)  # the parse tree only; matching is Spark's
    except (re.error, AttributeError, RecursionError, OverflowError):
        return None
    return _needed(parsed)


def runs_of(formula: Formula) -> set[str]:
    if formula is None:
        return set()
    return {formula} if isinstance(formula, str) else set().union(*map(runs_of, formula[1]))


def _fulfilled(formula: Formula) -> Column:
    if isinstance(formula, str):
        return F.array_contains("runs", formula)
    tests = [_fulfilled(p) for p in formula[1]]
    return reduce((lambda a, b: a & b) if formula[0] == "and" else (lambda a, b: a | b), tests)


# ---------------------------------------------------------------- index

#: Characters beyond ASCII that match an ASCII letter whatever its case, and that letter.
_LIKE_ASCII = ("\u0130\u0131\u017f\u212a", "iisk")


def folded(c: str) -> Column:
    """Text in which what matches an ASCII character whatever its case is that
    character in lower case."""
    return F.lower(F.translate(F.coalesce(F.col(c), F.lit("")), *_LIKE_ASCII))


def _bucket(c: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(folders)).cast("int")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``run, review_ids`` for rows ``review_id, both``: the runs of ASCII characters, each
    with the rows that have it, once a row.  In UTF-8 such a run is as many bytes below 128."""
    from feedlens.llm.text import text_chunks

    for batch in batches:
        for rows, data, offsets in text_chunks(batch, "both", LISTED_BYTES):
            size = max(len(data) - GRAM + 1, 0)
            row = np.repeat(np.arange(rows.num_rows), np.diff(offsets))
            inside = row[:size] == row[GRAM - 1:]
            code = np.zeros(size, np.int64)
            for j in range(GRAM):
                inside &= data[j:j + size] < 128
                code = code << 7 | data[j:j + size]
            pairs = np.unique(code[inside] * rows.num_rows + row[:size][inside])
            codes, starts = np.unique(pairs // max(rows.num_rows, 1), return_index=True)
            runs = np.stack([codes >> 7 * (GRAM - 1 - j) & 127 for j in range(GRAM)], axis=1).astype(np.uint8)
            ids = rows.column(0).take(pa.array(pairs % max(rows.num_rows, 1)))
            ends = np.append(starts, len(pairs)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes().decode() for r in runs], pa.string()), pa.ListArray.from_arrays(pa.array(ends), ids)],
                names=["run", "review_ids"])


class SearchIndex:
    """Reviews (``review_id, text, title`` and any others) with their postings,
    under ``path``: ``rows`` by a hash of the id, ``postings`` by a hash of the run."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 gram_folders: int = GRAM_FOLDERS, row_folders: int = ROW_FOLDERS):
        self.spark, self.path, self.schema = spark, path, schema
        self.gram_folders, self.row_folders = gram_folders, row_folders

    def build(self, reviews: DataFrame) -> SearchIndex:
        """Write rows and postings.  A run counts once a row; a run has a list for each few
        megabytes of text, so those of a run of a third of all rows are rows like others, dealt
        evenly (a rebalance) and sorted inside their files."""
        ship_package(self.spark)
        row_folder = _bucket(F.col("review_id"), self.row_folders).alias("folder")
        rows = reviews.select(*self.schema.fieldNames(), row_folder).hint("rebalance", "folder")
        rows.write.mode("overwrite").partitionBy("folder").parquet(f"{self.path}/rows")
        both = F.concat(folded("text"), F.lit("\n"), folded("title"))
        written = self.spark.read.schema(self._row_schema()).parquet(f"{self.path}/rows")
        listed = written.select("review_id", both.alias("both")).mapInArrow(
            _listed, f"run string, review_ids array<{self._id_kind()}>")
        postings = listed.withColumn("folder", _bucket(F.col("run"), self.gram_folders))
        (postings.hint("rebalance", "folder").sortWithinPartitions("folder", "run").write.mode("overwrite")
         .partitionBy("folder").parquet(f"{self.path}/postings"))
        return self

    def _id_kind(self) -> str:
        return self.schema["review_id"].dataType.simpleString()

    def _row_schema(self) -> T.StructType:
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        return T.StructType([*fields, T.StructField("folder", T.IntegerType())])

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self._row_schema()).parquet(f"{self.path}/rows")

    def candidates(self, formula: Formula) -> DataFrame:
        """``review_id`` (once each, null possibly among them) of the rows that fulfil ``formula``.  Only
        the folders, and inside them the row groups, of its runs are read."""
        runs = sorted(runs_of(formula))
        read = self.spark.read.schema(f"run string, review_ids array<{self._id_kind()}>, folder int").parquet(f"{self.path}/postings")
        folders = self.spark.createDataFrame([(r,) for r in runs], "run string").select(
            _bucket(F.col("run"), self.gram_folders)).distinct().collect()
        hits = read.where(F.col("folder").isin(*(r[0] for r in folders)) & F.col("run").isin(*runs)).select(
            "run", F.explode("review_ids").alias("review_id"))
        return hits.groupBy("review_id").agg(F.collect_set("run").alias("runs")).where(_fulfilled(formula)).select("review_id")

    def search(self, pattern: str) -> DataFrame:
        """the rows that match ``pattern`` in text or title, whatever its
        case, in the columns of the index's schema; the same rows as
        ``search.search_reviews`` over all rows.

        Rows that share an id are candidates together.  Only the folders of
        candidates are read; the pattern is tested on candidates alone."""
        columns = self.schema.fieldNames()
        formula = needed_runs(pattern) if pattern else None
        if formula is None:
            return search_reviews(self.rows().select(*columns), pattern)
        checkpoint_root(self.spark)
        found = self.candidates(formula).select(F.col("review_id").alias("_id")).checkpoint(eager=True)
        folders = [r[0] for r in found.select(_bucket(F.col("_id"), self.row_folders)).distinct().collect()]
        rows = self.rows().where(F.col("folder").isin(*folders) if folders else F.lit(False))
        rows = rows.join(found, rows["review_id"].eqNullSafe(found["_id"]), "left_semi")
        return search_reviews(rows.select(*columns), pattern)
