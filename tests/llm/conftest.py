import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: doc_id, text, lang, source: null and repeated ids, null, empty, blank and
#: long texts, equal texts, near copies and short texts.
BASE = " ".join(f"word{i}" for i in range(60))
EDGE_ROWS = [
    (1, BASE, "en", "src0"), (2, BASE.upper(), "en", "src0"), (3, BASE + " tail", None, "src1"),
    (4, BASE.replace("word30", "other"), "en", None), (5, None, "en", "src1"), (6, "", "de", "src1"),
    (7, " \t\n", "de", "src1"), (8, "one two three", "en", "src2"), (9, "One two three", "en", "src2"),
    (10, "a b c d e", "en", "src2"), (None, "no id at all here", "en", "src2"), (None, "no id at all here", "en", "src2"),
    (11, "same row", "fr", "src3"), (11, "same row", "fr", "src3"), (12, "é" * 300, "fr", "src3"),
    (13, " ".join(f"long{i % 997}" for i in range(30000)), "es", "src0"), (14, "x", "es", "src0"),
    (15, "Ünïcode Ä text with ÄÖÜ words here", "de", "src9"),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with a clashing extra column or two."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGE_ROWS, DOC_SCHEMA)
    return rows.withColumns({"n_chars": F.lit(1).cast("long"), "digest": F.lit("x"), "token": F.lit(0), "score": F.lit(2.0)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA + ", n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")
