import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedlens.functions.lexicon import FALLBACK_THEME
from feedlens.operators import prompts, replies, themes
from feedlens.sources import readers


def test_feed_bodies(spark):
    two = {"feed": {"entry": [
        {"updated": {"label": "2026-07-01T10:00:00-07:00"}, "im:rating": {"label": "4"},
         "title": {"label": "ok"}, "content": {"label": "fine"}},
        {"updated": {"label": "2026-07-02T10:00:00Z"}, "im:rating": {"label": "2"},
         "title": {"label": "meh"}, "content": {"label": "slow"}}]}}
    one = {"feed": {"entry": {"updated": {"label": "2026-07-03T00:00:00Z"}, "im:rating": {"label": "5"},
                              "title": {"label": "single"}, "content": {"label": "one"}}}}
    title_only = {"feed": {"entry": [{"title": {"label": "only a title"}}]}}
    pages = spark.createDataFrame(
        [(1, json.dumps(two)), (2, json.dumps(one)), (3, json.dumps({"feed": {}})),
         (4, json.dumps(title_only)), (5, "not json")], "page long, body string")
    rows = readers.scan_appstore_feed(pages).orderBy("page", "title").collect()
    assert [r.page for r in rows] == [1, 1, 2]
    assert rows[1].date == dt.datetime(2026, 7, 1, 17, 0)
    assert rows[2].title == "single" and rows[2].rating == 5
    assert all(r.source == "appstore" for r in rows)
    rejects = {(r.page, r.position, r.reason): r.record for r in readers.scan_appstore_feed_rejects(pages).collect()}
    assert set(rejects) == {(4, 0, "no ISO date"), (5, None, "not JSON")}
    assert json.loads(rejects[4, 0, "no ISO date"]) == {"title": {"label": "only a title"}}
    assert rejects[5, None, "not JSON"] == "not json"


def test_feed_kept_and_rejected_are_all_entries(spark):
    date = {"label": "2026-07-01T10:00:00Z"}
    entries = [
        {"id": {"label": "gp:x_1"}, "updated": date, "im:rating": {"label": "4.0"}},
        {"id": {"label": "12"}, "updated": date, "im:rating": {"label": "9"}, "content": {"label": "a \"b\" é"}},
        {"updated": {"label": "bad"}}, {"updated": {"label": "10:30"}}, {"updated": date}, {}, "text", 7, None, [date],
        {"updated": "no label"},
    ]
    bodies = [(1, json.dumps({"feed": {"entry": entries}})), (2, json.dumps({"feed": {"entry": "none"}})), (3, None),
              (4, json.dumps({"feed": {"entry": []}})), (5, json.dumps({"other": 1})), (6, ""), (7, '{"feed": {"entry": [{"up')]
    pages = spark.createDataFrame(bodies, "page long, body string").withColumn("rating", F.lit(3)).withColumn("e", F.lit("x"))
    kept, rejects = readers.scan_appstore_feed(pages).collect(), readers.scan_appstore_feed_rejects(pages).collect()
    assert [(r.review_id, r.rating) for r in kept] == [("gp:x_1", 4), ("12", None), (None, None)]
    assert kept[1].text == 'a "b" é' and all(r.date is not None for r in kept)
    on_page = [r for r in rejects if r.position is not None]
    assert len(kept) + len(on_page) == len(entries)
    assert {(r.position, r.reason) for r in on_page} == {
        (2, "no ISO date"), (3, "no ISO date"), (5, "no ISO date"), (10, "no ISO date"),
        (6, "not an entry"), (7, "not an entry"), (8, "not an entry"), (9, "not an entry")}
    assert {(r.page, r.reason) for r in rejects if r.position is None} == {
        (2, "entry is no list"), (3, "not JSON"), (6, "not JSON"), (7, "not JSON")}
    normal = readers.normalize_reviews(app=pages).collect()
    assert [(r.review_id, r.rating) for r in normal] == [("gp:x_1", 4), ("12", None), (None, None)]
    assert readers.scan_appstore_feed(pages.where("page > 9")).count() == 0


def test_dump_records_are_kept_or_rejected_and_ids_are_text(spark, tmp_path):
    lines = ['{"review_id": "t3_abc", "source": "reddit", "rating": "4.0", "text": "a", "date": "2024-01-05"}',
             '{"review_id": 17, "source": "appstore", "rating": 9, "text": "b", "date": "2024-01-05"}',
             '{"source": "twitter", "text": "c", "date": "10:30"}', "[1, 2]", "nothing", '{"source": "twitter", "text": "c"',
             '{"source": "linkedin", "text": "d", "date": "2024-01-05T10:00:00Z", "rating": {"x": 1}}']
    path = tmp_path / "dump.json"
    path.write_text("\n".join(lines))
    kept = readers.scan_reviews_json(spark, str(path), multi_line=False).collect()
    rejects = readers.scan_reviews_json_rejects(spark, str(path), multi_line=False).collect()
    assert {(r.review_id, r.source, r.rating) for r in kept} == {("t3_abc", "reddit", 4), ("17", "appstore", None), (None, "linkedin", None)}
    assert len(kept) + len(rejects) == len(lines)
    assert sorted(r.reason for r in rejects) == ["no ISO date", "not JSON", "not JSON", "not JSON"]


KEY_ROWS = "review_id string, source string, rating int, title string, text string, date string"


def test_review_keys_are_unique_and_the_same_for_any_order_of_files(spark):
    from feedlens.sources.identity import with_review_key
    rows = [("t3_a", "reddit", None, None, "x", "2024-01-05"), ("t3_a", "reddit", 4, None, "x", "2024-01-05"),
            ("t3_a", "appstore", None, None, "x", "2024-01-05"), ("", "reddit", None, "t", "x", "d"), (None, "reddit", None, "t", "x", "d"),
            (None, None, None, None, None, None), (None, None, None, None, None, None), ("#1", "reddit", None, "ab", "c", "d"),
            (None, "reddit", None, "a", "bc", "d"), (None, "reddit", None, "ab", "c", "d"), ("t3_a#1", "reddit", 1, "", "", "")]
    rows += [(None, "twitter", None, None, "", "2024-01-05")] * 3000
    keys = []
    for parts, order in ((1, "text"), (7, "rating"), (16, "review_id")):
        df = spark.createDataFrame(rows, KEY_ROWS).orderBy(order).repartition(parts)
        out = with_review_key(df)
        assert out.columns == [*df.columns, "review_key"]
        found = [tuple(r) for r in out.collect()]
        assert len(found) == len(rows) == len({r[-1] for r in found})
        keys.append(sorted(found, key=repr))
    assert keys[0] == keys[1] == keys[2]
    assert with_review_key(spark.createDataFrame([], KEY_ROWS)).count() == 0


PAYLOAD = {
    "themes": [{"id": "t1", "name": "Pricing", "description": "d1"},
               {"id": "t2", "name": "Delivery", "description": "d2"},
               {"id": "t1", "name": "Pricing v2", "description": "d1b"}],
    "clustering": [{"review_index": 1, "theme_id": "t1"}, {"review_index": 2, "theme_id": "t2"},
                   {"review_index": 2, "theme_id": "t1"}, {"review_index": 3, "theme_id": "zz"}],
    "question_answers": {"struggle_points": "lag"},
    "weekly_note": {"top_themes": [{"rank": 9, "name": "Pricing", "rationale": "r"}],
                    "user_quotes": ["q1", "q2"], "action_ideas": ["a1"]},
}


def test_parse_responses(spark):
    good = json.dumps(PAYLOAD)
    fenced = "Here you go:\n```json\n" + good + "\n```\nThanks"
    df = spark.createDataFrame([(1, good), (2, fenced), (3, "nope"), (4, "")],
                               "batch long, response string")
    out = {r.batch: r for r in replies.parse_responses(df).collect()}
    assert out[1].status == "ok" and out[2].status == "recovered"
    assert out[3].status == "rejected" and out[3].payload is None
    assert out[4].status == "rejected"
    assert len(out[2].payload.themes) == 3


def test_explode_and_back_join(spark):
    df = spark.createDataFrame([("s", 0, json.dumps(PAYLOAD))], "source string, batch long, response string")
    parts = prompts.explode_payload(replies.parse_responses(df))
    assert parts["assignments"].count() == 4
    assert {r.question_key for r in parts["answers"].collect()} == {"struggle_points"}
    numbered = spark.createDataFrame([("s", 0, i, 100 + i) for i in (1, 2, 3, 4)],
                                     "source string, batch long, review_index int, review_id long")
    out = {r.review_index: r.theme for r in
           themes.theme_back_join(numbered, parts["assignments"], parts["themes"]).collect()}
    # last wins for index 2 (t1) and for theme t1 (Pricing v2); unknown id and
    # missing index fall back.
    assert out == {1: "Pricing v2", 2: "Pricing v2", 3: FALLBACK_THEME, 4: FALLBACK_THEME}


def test_every_reply_is_parsed_or_quarantined(spark, tmp_path):
    good = json.dumps(PAYLOAD)
    texts = [good, f"```json\n{good}\n```", good[:40], "no object here", "", None, '{"themes": null}', "[1]", '{"other": 1} {']
    lines = [json.dumps({"source": "s", "batch": i, "response": t}) for i, t in enumerate(texts)] + ['{"source": "s", "bat']
    (tmp_path / "r.json").write_text("\n".join(lines))
    read = readers.scan_replies(spark, str(tmp_path))
    parsed = replies.parse_responses(read)
    assert parsed.count() == len(lines)
    out = {r.batch: (r.status, r.reason) for r in parsed.collect()}
    assert out == {0: ("ok", None), 1: ("recovered", None), 2: ("rejected", "broken JSON"), 3: ("rejected", "no JSON object"),
                   4: ("rejected", "no reply"), 5: ("rejected", "no reply"), 6: ("rejected", "no themes"),
                   7: ("rejected", "no JSON object"), 8: ("rejected", "no themes"), None: ("rejected", "broken JSON")}
    held = {r.batch: r.response for r in replies.quarantine(parsed).collect()}
    assert held == {i: texts[i] for i in range(2, 9)} | {None: '{"source": "s", "bat'}
    assert readers.scan_replies(spark, str(tmp_path / "absent")).count() == 0


def _counted(folder, fail=()):
    """A call that leaves a file each time, and raises or ends its process for
    the prompts that hold a word of ``fail``."""
    def call(prompt):
        import os
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        for word, how in fail:
            if word in prompt:
                if how == "raise":
                    raise RuntimeError(f"busy: {word}")
                if how == "none":
                    return None
                os._exit(1)
        return f"reply to {prompt}"
    return call


def _calls(folder):
    return sorted(f.read_text() for f in folder.iterdir())


def test_a_failing_call_is_a_row_and_is_tried_again(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    bodies = [("a", 0, "one"), ("a", 1, "two"), ("b", 0, "one"), ("b", 1, None), ("b", 2, "three")]
    df = spark.createDataFrame(bodies, "source string, batch long, body string")
    store = replies.ReplyStore(spark, str(tmp_path / "store"))
    fail = [("two", "raise"), ("three", "none")]
    run = lambda f: {(r.source, r.batch): (r.response, r.error, r.attempts) for r in
                     replies.annotate_batches(df, _counted(calls, f), store, instructions="> ").collect()}
    out = run(fail)
    assert out == {("a", 0): ("reply to > one", None, 1), ("b", 0): ("reply to > one", None, 1), ("b", 1): ("reply to > ", None, 1),
                   ("a", 1): (None, "RuntimeError: busy: two", 1), ("b", 2): (None, "no text but NoneType", 1)}
    assert _calls(calls) == ["> ", "> one", "> three", "> two"]  # equal prompts share a call
    assert run([])["a", 1] == ("reply to > two", None, 2)
    assert _calls(calls) == ["> ", "> one", "> three", "> three", "> two", "> two"]
    assert run(fail) == run([]) and len(_calls(calls)) == 6  # all are answered: no call
    assert replies.annotate_batches(df.where("batch > 9"), _counted(calls), store).count() == 0


def test_a_restart_calls_no_finished_prompt_again(spark, tmp_path):
    """The third prompt ends its worker, and so the job, after tasks before it ended."""
    calls = tmp_path / "calls"
    calls.mkdir()
    df = spark.createDataFrame([("s", i, f"body {i:02d}.") for i in range(30)], "source string, batch long, body string")
    store = replies.ReplyStore(spark, str(tmp_path / "store"))
    with pytest.raises(Exception):
        replies.annotate_batches(df, _counted(calls, [("body 03", "exit")]), store, calls_per_task=1)
    kept = store.rows().count()
    before = len(_calls(calls))
    out = replies.annotate_batches(df, _counted(calls), store, calls_per_task=1)
    assert out.where("response is not null").count() == 30
    assert len(_calls(calls)) - before == 30 - kept and store.rows().count() == 30


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_prompts_are_laid_out_as_numbered(spark, parts):
    """Numbers, lines and batches equal a window's, with a channel of two thirds
    of the rows, null dates, ties and batches over many tasks."""
    rows = [(i, "reddit" if i % 3 else ("twitter", None, "appstore")[i % 9 // 3], None, None, f"text {i} é",
             None if i % 11 == 0 else dt.datetime(2026, 7, 1 + i % 5)) for i in range(700)]
    df = spark.createDataFrame(rows, "review_id long, source string, rating int, title string, text string, date timestamp_ntz")
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1], r[5] is None, -r[5].timestamp() if r[5] else 0, r[0]))
    want, n = {}, {}
    for r in order:
        n[r[1]] = n.get(r[1], 0) + 1
        want[r[0]] = (r[1], n[r[1]])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert {r.review_id: (r.source, r.rn) for r in prompts.number_reviews(df).collect()} == want
        clean = df.withColumn("source", F.coalesce("source", F.lit("unknown")))
        lines = prompts.prompt_lines(clean).collect()
        assert {r.review_id: (r.source, r.rn) for r in lines} == {i: (s or "unknown", k) for i, (s, k) in want.items()}
        for r in lines:
            assert r.line.startswith(f"Review #{r.rn} [Source: {r.source} | Date: ") and f'"text {r.review_id} é"' in r.line
        batches = prompts.pack_prompts(clean, size=7).collect()
        by_id = {(s or "unknown", k): i for i, (s, k) in want.items()}
        assert len(batches) == sum(-(-k // 7) for k in n.values()) and sum(r.n_reviews for r in batches) == 700
        for r in batches:
            texts = [f'"text {by_id[r.source, 7 * r.batch + j]} é"' for j in range(1, r.n_reviews + 1)]
            assert [x for x in r.body.split("\n") if x.startswith('"')] == texts
            assert [x.split(" ")[1] for x in r.body.split("\n") if x.startswith("Review")] == [f"#{j}" for j in range(1, r.n_reviews + 1)]
        everything = prompts.pack_prompts(clean, size=50, by=()).collect()
        assert sorted((r.batch, r.n_reviews) for r in everything) == [(b, 50) for b in range(14)]
        assert prompts.pack_prompts(clean.where("review_id < 0")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_without_an_order_among_them_are_all_packed(spark):
    rows = [(None, "reddit", None, None, f"text {i % 3}", None) for i in range(200)]
    df = spark.createDataFrame(rows, "review_id long, source string, rating int, title string, text string, date timestamp_ntz")
    batches = prompts.pack_prompts(df, size=7).collect()
    assert sorted((r.batch, r.n_reviews) for r in batches) == [(b, 7 if b < 28 else 4) for b in range(29)]


def test_numbering_moves_no_text(spark):
    from feedlens.operators.privacy import clean_reviews
    from feedlens.sources import tables
    from tests.conftest import SF001
    numbered = prompts.number_reviews(clean_reviews(tables.reviews(spark, SF001)))
    assert numbered.columns == ["review_id", "source", "date", "rn"]
    # What is written is all that the numbering's plan reads.
    assert "text" not in numbered._jdf.queryExecution().analyzed().toString()


def test_prompt_line_omits_empty_fields(spark):
    df = spark.createDataFrame(
        [(1, "reddit", None, None, "hi", dt.datetime(2026, 7, 1)),
         (2, "appstore", 0, "", "yo", dt.datetime(2026, 7, 1)),
         (3, "appstore", 4, "T", "x", dt.datetime(2026, 7, 1))],
        "review_id long, source string, rating int, title string, text string, date timestamp_ntz")
    lines = {r.review_id: r.line for r in
             df.select("review_id", prompts.prompt_line(F.col("review_id")).alias("line")).collect()}
    assert lines[1] == 'Review #1 [Source: reddit | Date: 2026-07-01T00:00:00.000000+00:00]:\n"hi"\n\n'
    assert "Rating" not in lines[2] and "Title" not in lines[2]
    assert "| Rating: 4/5 | Title: T |" in lines[3]


def test_review_keys_move_kept_columns_alone(spark, monkeypatch):
    """columns that the result does not have are hashed and left."""
    from feedlens.sources import identity

    rows = [("a", "reddit", None, None, "x", "d"), ("a", "reddit", 4, None, "y", "d"), (None, "reddit", None, "t", "x", "d"),
            (None, "reddit", None, "t", "x", "d"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, KEY_ROWS)
    want = sorted(tuple(r) for r in identity.with_review_key(df).select("review_key", "source").na.fill("").collect())
    seen = []
    number = identity.number_within
    monkeypatch.setattr(identity, "number_within", lambda d, *a, **k: seen.append(d.columns) or number(d, *a, **k))
    out = identity.with_review_key(df, keep=("source",))
    assert out.columns == ["source", "review_key"]
    assert sorted(tuple(r) for r in out.select("review_key", "source").na.fill("").collect()) == want
    assert seen and not {"text", "title", "date"} & set(seen[0])
