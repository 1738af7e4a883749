import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from feedlens.session import ensure_utc

    ckpt = tempfile.mkdtemp(prefix="feedlens-test-ckpt-")
    s = (SparkSession.builder.master("local[*]")
         .appName("feedlens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_utc(s)
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


# Golden fixture: 14 reviews shaped like the reference's bundled dump
# (4 appstore, 1 playstore, 4 reddit, 2 linkedin, 3 twitter; ratings
# 1, 1, 2, 2, 5 and nine NULLs; three NULL titles; three emails and one
# phone number).  The texts are our own.
GOLDEN = [
    (1, "appstore", 1, "Crashes at checkout", "App crashed twice while paying. Mail me at pat.k@mail.example", "2026-06-15T10:00:00Z"),
    (2, "appstore", 2, "Slow delivery", "The order took two hours and the food was cold.", "2026-06-18T12:30:00Z"),
    (3, "appstore", 5, "Great prices", "Cheaper than other apps, and the menu is clear.", "2026-06-22T08:15:00Z"),
    (4, "appstore", 1, "Refund pending", "Still waiting on a refund; call 9876543210 if needed.", "2026-06-25T14:30:00Z"),
    (5, "playstore", 2, None, "Cart keeps freezing when adding items.", "2026-06-28T09:00:00Z"),
    (6, "reddit", None, "Is it worth it?", "Tried it this week, support replied by mail: help@desk.example", "2026-06-20T16:45:00Z"),
    (7, "reddit", None, "Delivery partner issues", "Rider could not find the street and called three times.", "2026-06-23T11:00:00Z"),
    (8, "reddit", None, "Zero commission", "Restaurants like the model but the app is buggy.", "2026-07-01T19:20:00Z"),
    (9, "reddit", None, "Discovery", "Could not find the app in the store search at all.", "2026-07-02T07:05:00Z"),
    (10, "linkedin", None, "Launch post", "Proud of the launch; reach the team at jobs@corp.example", "2026-06-30T13:00:00Z"),
    (11, "linkedin", None, "Partner onboarding", "Onboarding restaurants took longer than planned.", "2026-07-03T10:10:00Z"),
    (12, "twitter", None, None, "Food arrived cold again, no chat support.", "2026-07-04T21:00:00Z"),
    (13, "twitter", None, None, "Loving the lower prices on my usual order.", "2026-07-05T18:30:00Z"),
    (14, "twitter", None, "", "UPI payment failed twice, then went through.", "2026-07-06T20:40:00Z"),
]
GOLDEN_AS_OF = "2026-07-07T00:00:00+00:00"


@pytest.fixture(scope="session")
def golden(spark):
    from pyspark.sql import functions as F
    raw = spark.createDataFrame(
        [(i, s, r, t, x, d) for i, s, r, t, x, d in GOLDEN],
        "review_id long, source string, rating int, title string, text string, date string")
    from feedlens.functions.dates import parse_date
    return raw.withColumn("date", parse_date(F.col("date")))
