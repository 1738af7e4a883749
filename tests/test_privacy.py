import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlens.functions.text import EMAIL_PATTERN, PHONE_PATTERN, mask_pii
from feedlens.operators import metrics, privacy

# FIXTURES F-4: literal edge rows and the masks Python's ``re`` produces.
EDGE = [
    ("a jörg@mail.de b", "a [EMAIL] b"),
    ("john.@x.co.", "[EMAIL]."),
    ("a@b.c@d.e", "[EMAIL]@d.e"),
    ("+91 98765 43210.", "[PHONE]."),
    ("98765-43210", "[PHONE]"),
    ("98765\n43210", "[PHONE]"),
    ("987-654-3210", "[PHONE]"),
    ("x123456789876543210", "x12345678[PHONE]"),
    ("ü9876543210", "ü[PHONE]"),
    ("9876543210ü", "9876543210ü"),
    ("", ""),
    (None, ""),
]


def py_mask(text):
    if not text:
        return ""
    text = re.sub(EMAIL_PATTERN, "[EMAIL]", text)
    return re.sub(PHONE_PATTERN, "[PHONE]", text)


def test_edge_rows(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(EDGE)], "i int, x string")
    got = {r.i: r.m for r in df.select("i", mask_pii("x").alias("m")).collect()}
    for i, (x, want) in enumerate(EDGE):
        assert got[i] == want, (x, got[i], want)
        assert py_mask(x) == want


ALPHABET = "ab.-_@ 0123456789+\nüé91"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=40), min_size=300, max_size=300))
def test_matches_python_re_and_is_idempotent(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", mask_pii("t").alias("m"), mask_pii(mask_pii("t")).alias("mm")).collect()
    for r in rows:
        assert r.m == py_mask(texts[r.i]), texts[r.i]
        assert r.mm == r.m


def test_golden_masking_changes_four_rows(golden):
    clean = privacy.clean_reviews(golden)
    joined = golden.alias("a").join(clean.alias("b"), "review_id")
    changed = joined.where(F.col("a.text") != F.col("b.text")).count()
    assert changed == 4
    marked = privacy.pii_marked_rows(clean).count()
    assert marked == 4
    kpi = metrics.dashboard_kpis(clean).first()
    assert kpi.total_reviews == 14 and kpi.masked_rows == 4 and kpi.active_channels == 5
    assert kpi.avg_rating == 2.2


def test_clean_reviews_whitelist_and_defaults(spark):
    df = spark.createDataFrame(
        [(1, None, 3, "", "call 9876543210", None, "secret"),
         (2, "reddit", None, "mail a@b.co", None, None, "x")],
        "review_id long, source string, rating int, title string, text string, date timestamp_ntz, extra string")
    out = {r.review_id: r for r in privacy.clean_reviews(df).collect()}
    assert "extra" not in privacy.clean_reviews(df).columns
    assert out[1].source == "unknown" and out[1].title is None and out[1].text == "call [PHONE]"
    assert out[2].title == "mail [EMAIL]" and out[2].text == ""


def test_incident_counts_equal_markers(golden):
    counts = {r.source: r for r in privacy.pii_incident_counts(golden).collect()}
    assert sum(r.email_hits for r in counts.values()) == 3
    assert sum(r.phone_hits for r in counts.values()) == 1
    assert sum(r.masked_rows for r in counts.values()) == 4


def test_masking_digits_of_any_script(spark):
    import random

    from feedlens.functions.text import EMAIL_PATTERN, PHONE_PATTERN
    from feedlens.operators.privacy import pii_incident_counts

    rng = random.Random(5)
    scripts = ["0123456789", "\u0966\u0967\u0968\u0969\u096a\u096b\u096c\u096d\u096e\u096f",
               "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669",
               "\uff10\uff11\uff12\uff13\uff14\uff15\uff16\uff17\uff18\uff19"]
    texts = []
    for _ in range(200):
        digits = rng.choice(scripts)
        number = "".join(rng.choice(digits) for _ in range(rng.choice([3, 9, 10, 11])))
        texts.append(rng.choice(["call ", "", "+91 ", "a@b.co "]) + number + rng.choice([" now", "", ".", "x"]))
    expected = [re.sub(PHONE_PATTERN, "[PHONE]", re.sub(EMAIL_PATTERN, "[EMAIL]", t)) for t in texts]
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "i int, source string, text string")
    got = [r[0] for r in df.orderBy("i").select(mask_pii("text")).collect()]
    assert got == expected
    counts = pii_incident_counts(df).first()
    assert counts.phone_hits == sum(t.count("[PHONE]") for t in expected)
    assert counts.email_hits == sum(t.count("[EMAIL]") for t in expected)
