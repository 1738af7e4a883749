import json
import os

from pyspark.sql import functions as F

from feedlens.operators import reports, themes
from feedlens.operators.privacy import clean_reviews
from feedlens.sources import readers, sinks
from feedlens.plans.params import QUESTION_TERMS, THEME_NAMES, THEME_TERMS


def test_themes_csv_roundtrip_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("t1", 'Say "hi", twice', None), ("t2", "Plain", "d")],
                               "theme_id string, name string, description string")
    path = str(tmp_path / "themes")
    assert sinks.sink_themes_csv(df, path)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    text = open(os.path.join(path, files[0]), encoding="utf-8").read()
    assert text.splitlines()[0] == "Theme ID,Theme Name,Description"
    assert '"Say ""hi"", twice"' in text  # quotes doubled, not backslashed
    back = {r.theme_id: r for r in readers.scan_themes_csv(spark, path).collect()}
    # A missing field is written as an empty field and reads back as NULL,
    # as a CSV reader such as pandas would give it.
    assert text.splitlines()[1].endswith(",")
    assert back["t1"].name == 'Say "hi", twice' and back["t1"].description is None
    empty = str(tmp_path / "none")
    assert not sinks.sink_themes_csv(df.where(F.lit(False)), empty)
    assert not os.path.exists(empty)


def test_qa_json_roundtrip(spark, tmp_path):
    answers = spark.createDataFrame([("r1", 2, "ordering_frustrations", "slow"), ("r1", 1, "struggle_points", "lag")],
                                    "report_key string, q_order int, question_key string, answer string")
    path = str(tmp_path / "qa")
    assert sinks.sink_qa_json(answers, path)
    line = spark.read.text(path).first().value
    assert json.loads(line) == {"report_key": "r1",
                                "question_answers": {"struggle_points": "lag", "ordering_frustrations": "slow"}}
    assert line.index("struggle_points") < line.index("ordering_frustrations")
    back = readers.scan_qa_json(spark, path).orderBy("q_order").collect()
    assert [r.answer for r in back] == ["lag", "slow", "N/A", "N/A", "N/A", "N/A"]
    assert not sinks.sink_qa_json(answers.where(F.lit(False)), str(tmp_path / "qa2"))


def test_notes_and_reviews_roundtrip(spark, golden, tmp_path):
    themed = themes.assign_themes(clean_reviews(golden), THEME_TERMS, THEME_NAMES)
    notes = reports.weekly_note(themed, questions=QUESTION_TERMS).withColumn("week_label", F.date_format("week", "yyyy-MM-dd"))
    path = str(tmp_path / "notes")
    sinks.sink_notes_text(notes, path)
    back = (spark.read.schema("value string, source string, week_label string").text(path, wholetext=True)
            .select(F.concat("source", F.lit("/"), "week_label").alias("k"),
                    F.regexp_replace("value", r"\n\z", "").alias("note")))
    want = {r.report_key: r.note for r in notes.collect()}
    assert {r.k: r.note for r in back.collect()} == want
    rpath = str(tmp_path / "labelled")
    sinks.sink_reviews_json(themed.select("review_id", "source", "rating", "title", "text", "date", "theme"), rpath)
    assert {d for d in os.listdir(rpath) if d.startswith("source=")} == {
        "source=appstore", "source=playstore", "source=reddit", "source=linkedin", "source=twitter"}
    loaded = readers.scan_labelled_reviews(spark, rpath)
    assert loaded.count() == 14
    assert loaded.where(F.col("text").contains("@")).count() == 0


def test_filtered_csv_keeps_whitespace_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([(1, " padded ", 'line1\nline2 "q"')], "review_id long, title string, text string")
    path = str(tmp_path / "csv")
    sinks.sink_filtered_csv(df, path)
    back = spark.read.schema("review_id long, title string, text string").options(**readers.CSV_OPTIONS).csv(path)
    r = back.first()
    assert r.title == " padded " and r.text == 'line1\nline2 "q"'
