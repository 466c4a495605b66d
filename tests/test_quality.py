"""Snapshot changes and instants: defined results in every odd case."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vacantia.sources.snapshots import assess_listings
from vacantia.operators.instants import read_instants, readings, share_of_first
from vacantia.operators.snapshots import snapshot_changes

DDL = "n int, k string, v timestamp, a string, b string, h string, _n string"


def changes(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DDL)
    return sorted(tuple(r) for r in snapshot_changes(df, "k", "n", "v", ["a", "b"]).collect())


def test_changes(spark):
    t = lambda h: datetime(2026, 1, 1, h)
    rows = [
        (1, "same", t(1), "x", None), (2, "same", t(2), "x", None), (2, "same", t(2), "x", None),
        (1, "null", t(1), None, "a"), (2, "null", t(2), "a", None), (1, "empty", t(1), None, ""), (2, "empty", t(2), "", ""),
        (1, "gone", t(1), "x", "x"), (3, "back", t(3), "x", "x"), (1, "back", t(1), "x", "x"),
        (2, "late", t(2), "old", "x"), (2, "late", t(9), "new", "x"), (1, "late", t(1), "new", "x"),
        (2, None, t(1), "x", "x"), (None, "k", t(1), "x", "x"), (3, "long", t(1), "z" * 200_000, None), (2, "nov", None, "x", "x"), (2, "nov", t(1), "y", "x"), (1, "nov", t(1), "y", "x"),
    ]
    assert changes(spark, rows) == sorted([(2, "null", "changed"), (2, "empty", "changed"), (2, "gone", "removed"), (2, "back", "removed"), (3, "back", "added"), (3, "same", "removed"), (3, "null", "removed"), (3, "empty", "removed"), (3, "late", "removed"), (3, "nov", "removed"), (3, "long", "added")])


def test_changes_of_little(spark):
    assert changes(spark, []) == [] and changes(spark, [(4, "a", datetime(2026, 1, 1), "x", "y")]) == []


def test_hot_key(spark):
    """A key with very many rows shrinks within the tasks."""
    df = spark.range(20_000).select((F.col("id") % 2 + 1).cast("int").alias("n"), F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("v"), F.col("id").cast("string").alias("a"))
    assert [tuple(r) for r in snapshot_changes(df, "k", "n", "v", ["a"]).collect()] == [(2, "hot", "changed")]


US = 10**6


@pytest.mark.parametrize(
    ("text", "zone", "iso"),
    [
        ("2026-05-25T20:20:17.759416+05:30", None, "2026-05-25T14:50:17.759416"), ("2026-04-03t11:14:00z", None, "2026-04-03T11:14:00"), ("2025-09-22T06:32:17,442+02:00", None, "2025-09-22T04:32:17.442"),
        ("2025-12-30 10:28", "Africa/Johannesburg", "2025-12-30T08:28:00"), ("2025-09-21T00:33:55.782255844Z", None, "2025-09-21T00:33:55.782255"), ("20260215T014117785279Z", None, "2026-02-15T01:41:17.785279"),
        ("Sun, 31 Aug 2025 23:46:26 +0200", None, "2025-08-31T21:46:26"), ("17 Aug 2026", "Europe/London", "2026-08-16T23:00:00"), ("26 Jun 2026 13:24 SAST", None, "2026-06-26T11:24:00"),
        ("2026-05-05 17:35:12 UTC+2", None, "2026-05-05T15:35:12"), ("2025-12-18T22:53:43[Africa/Johannesburg]", None, "2025-12-18T20:53:43"), ("2026-11-02T10:54:48 -05", None, "2026-11-02T15:54:48"),
        ("August 28, 2025 05:16 AM", "UTC", "2025-08-28T05:16:00"), ("1787751926", None, "2026-08-26T13:45:26"), ("1758456655964", None, "2025-09-21T12:10:55.964"), ("2026-01-26T04:50:06[UTC]", None, "2026-01-26T04:50:06"),
        ("12:00 AM", None, None),
    ],
)
def test_readings(text, zone, iso):
    _, us, status, *_ = readings(text, zone)
    want = None if iso is None else (datetime.fromisoformat(iso) - datetime(1970, 1, 1))
    assert us == (None if want is None else (want.days * 86400 + want.seconds) * US + want.microseconds), status


@pytest.mark.parametrize(
    ("text", "zone", "status"),
    [
        (None, "UTC", "null"), ("  ", "UTC", "null"), ("2026-02-30 08:15:00", "UTC", "unreadable"), ("2026", "UTC", "unreadable"), ("25:61", "UTC", "unreadable"), ("2026-01-01 10:00", None, "no_zone"),
        ("2026-01-01 10:00", "Mars/Base", "no_zone"), ("2026-10-25 01:30", "Europe/London", "twice"), ("2026-03-29 01:30", "Europe/London", "never"), ("x" * 300_000, "UTC", "unreadable"), ("9" * 5000, "UTC", "unreadable"),
    ],
)
def test_unresolved(text, zone, status):
    assert readings(text, zone)[2] == status


def test_mixture():
    assert share_of_first([1, 3], [90, 10], 0.5, 0.01) > 0.99 and share_of_first([3], [10], 0.5, 4.0) == pytest.approx(0.5)


def test_day_month_order_per_source(spark):
    rows = [("us", "01/25/2026 10:00")] * 30 + [("us", "03/04/2026 10:00")] + [("eu", "25/01/2026 10:00")] * 30 + [("eu", "03/04/2026 10:00"), ("eu", "05/05/2026"), ("odd", "03.04.2026"), (None, None), ("eu", "2026-01-01")]
    df = spark.createDataFrame([(i, s, v, "UTC", "clash") for i, (s, v) in enumerate(rows)], "id int, src string, v string, z string, _form string").withColumn("time_status", F.lit("old"))
    out = {r.id: r for r in read_instants(df, "v", "z", ["src"]).collect()}
    assert len(out) == len(rows) and out[0]._form == "clash"
    day = lambda i: out[i].epoch_us // (86400 * US)
    assert day(30) == (datetime(2026, 3, 4) - datetime(1970, 1, 1)).days and day(61) == (datetime(2026, 4, 3) - datetime(1970, 1, 1)).days
    assert day(62) == (datetime(2026, 5, 5) - datetime(1970, 1, 1)).days
    assert out[63].time_status == "ambiguous" and out[63].epoch_us is None and out[64].time_status == "null" and out[65].time_status == "ok"
    assert read_instants(df.limit(0), "v", "z", ["src"]).count() == 0


def test_shared_abbreviations(spark):
    """BST, IST and the like are read by the zones that the source, or else all sources, name; else they are ambiguous."""
    rows = [(1, "2026-07-01 10:00 BST", None, "a"), (2, "2026-07-01 10:00 IST", "Asia/Kolkata", "b"), (3, "2026-07-01 10:00 IST", "Europe/Dublin", "c"), (4, "2026-07-01 10:00 CST", None, "d"), (5, "03/04/2026 10:00 EST", "America/New_York", "e")]
    rows += [(10 + k, "2026-07-01 10:00:00 Europe/London", None, "z") for k in range(30)] + [(50 + k, "2026-07-01", "Asia/Kolkata", "b") for k in range(60)] + [(200 + k, "2026-07-01", "Europe/Dublin", "c") for k in range(60)]
    rows += [(300 + k, "2026-07-01", "America/New_York", "e") for k in range(60)] + [(400 + k, f"25/{k % 9 + 1}/2026 10:00", None, "e") for k in range(40)]
    df = spark.createDataFrame(rows, "id int, v string, z string, src string")
    out = {r.id: (r.time_status, r.epoch_us) for r in read_instants(df, "v", "z", ["src"]).collect()}
    at = lambda iso: int((datetime.fromisoformat(iso) - datetime(1970, 1, 1)).total_seconds()) * US
    assert out[1] == ("ok", at("2026-07-01T09:00:00")) and out[2] == ("ok", at("2026-07-01T04:30:00")) and out[3] == ("ok", at("2026-07-01T09:00:00"))
    assert out[4] == ("ambiguous", None) and out[5] == ("ok", at("2026-04-03T15:00:00")) and len(out) == len(rows)
    alone = read_instants(spark.createDataFrame([(1, "2026-07-01 10:00 BST", None, "a")], "id int, v string, z string, src string"), "v", "z", ["src"]).first()
    assert alone.time_status == "ambiguous" and alone.epoch_us is None


def test_listing_pages(spark):
    rows = [("a", 200, "text/html", "<p>Our team</p><a href='/job/1'>x</a><a href='/job/1'>y</a>"), ("b", 404, "application/json", None), ("c", 200, "text/html", "<a href='/job/2'>x</a>")]
    df = spark.createDataFrame(rows, "source_token string, http_status int, content_type string, html string")
    out = {r.source_token: r for r in assess_listings(df, ["Team"], at_home=F.col("source_token") == "a").collect()}
    assert out["a"].passed and out["a"].total_jobs == 1 == out["a"].home_jobs and out["b"].errors == ["status", "content_type", "missing_terms", "no_links"] and out["c"].missing_terms == ["Team"] and out["c"].home_jobs == 0
