"""Timestamp normalisation: forms, zones, clock changes, estimation, edge cases."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from newsloom.operators import timestamps as T

FETCHED = datetime(2025, 11, 20, 12, 0, 0)
CASES = {
    "2025-09-15T03:42:15+00:00": "2025-09-15T03:42:15",
    "2025-09-15T03:42:15.999Z": "2025-09-15T03:42:15",
    "20250916T060641Z": "2025-09-16T06:06:41",
    "Tue Sep 16 03:27:28 +0000 2025": "2025-09-16T03:27:28",
    "Wed, 17 Sep 2025 09:29:46 +0900": "2025-09-17T00:29:46",
    "Tue, 28 Oct 2025 22:22:42 CET": "2025-10-28T21:22:42",
    "Mon, 10 Nov 2025 02:54:23 PST": "2025-11-10T10:54:23",
    "2025-09-22T06:38+08:00": "2025-09-21T22:38:00",
    "2025-09-17 17:19:05+0530": "2025-09-17T11:49:05",
    "2025-10-09T10:41:39+05:30[Asia/Kolkata]": "2025-10-09T05:11:39",
    "27 September 2025, 04:22 Asia/Shanghai": "2025-09-26T20:22:00",
    "Sep 26, 2025 9:38 AM UTC+08:00": "2025-09-26T01:38:00",
    "Nov 15, 2025 12:08 PM EST": "2025-11-15T17:08:00",
    "1757934180": "2025-09-15T11:03:00",
    "1758248713695": "2025-09-19T02:25:13",
    "1758273206.598": "2025-09-19T09:13:26",
    "1758014441694999": "2025-09-16T09:20:41",
    "3 hours ago": "2025-11-20T09:00:00",
    "1 day ago": "2025-11-19T12:00:00",
    "5分钟前": "2025-11-20T11:55:00",
    "2 小时前": "2025-11-20T10:00:00",
    # without zone: Berlin
    "2025-10-01 10:00:00": "2025-10-01T08:00:00",
    "2025年10月1日 10:00": "2025-10-01T08:00:00",
    "Oct 1, 2025 10:00 pm": "2025-10-01T20:00:00",
    "2025-10-26 02:30:00": "2025-10-26T00:30:00",  # twice there: the first
    "2026-03-29 02:30:00": None,  # skipped by the clock
    "2025-10-05": "2025-10-04T22:00:00",
    " 2025/10/01 10:00 ": "2025-10-01T08:00:00",
    "2025-11-31": None, "2026-13-01T00:00:00Z": None, "25:61": None, "Sat Mar": None, "unknown": None, "": None, "  ": None, "0000-00-00 00:00:00": None,
    "2025-10-01 24:10:00": None, "Oct 1, 2025 13:00 PM": None, "x" * 100_000: None, None: None,
}


def zones(spark, rows=(("s", "Europe/Berlin"),)):
    return spark.createDataFrame(list(rows), "source_id string, tz string")


def normalized(spark, values, key="s", catalogue=None, **more):
    rows = [(i, v, key, FETCHED) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, date string, source_id string, fetched timestamp")
    return T.normalize_timestamps(df, value="date", fetched="fetched", key="source_id", zones=catalogue or zones(spark), zone_key="source_id", zone="tz", **more)


def test_forms(spark):
    got = {r["date"]: r["ts_second"] for r in normalized(spark, list(CASES)).collect()}
    for text, iso in CASES.items():
        want = None if iso is None else int(datetime.fromisoformat(iso).replace(tzinfo=timezone.utc).timestamp())
        assert got[text] == want, (text and text[:40], got[text], want)


def test_missing_zone_is_estimated(spark):
    # a source in Tokyo: readings lie nine hours ahead, each was fetched within minutes
    rows = [(i, f"2025-10-{i + 1:02d} 21:00:00", "new", datetime(2025, 10, i + 1, 12, 3, 0)) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, date string, source_id string, fetched timestamp")
    catalogue = zones(spark, [("a", "Asia/Tokyo"), ("b", "America/New_York"), ("c", "UTC"), ("d", "Australia/Sydney"), ("new", None)])
    out = T.normalize_timestamps(df, value="date", fetched="fetched", key="source_id", zones=catalogue, zone_key="source_id", zone="tz").collect()
    assert {r["ts_how"] for r in out} == {"estimated"}
    assert all(r["ts_second"] == int(datetime(2025, 10, r["id"] + 1, 12, tzinfo=timezone.utc).timestamp()) for r in out)


def test_a_source_that_moved_has_a_history(spark):
    # Tokyo until December, then New York; each reading was fetched within minutes
    zone = lambda i: "Asia/Tokyo" if i < 60 else "America/New_York"
    start = datetime(2025, 10, 2, 12, tzinfo=timezone.utc)
    times = [start + timedelta(days=i) for i in range(120)]
    rows = [(i, t.astimezone(ZoneInfo(zone(i))).strftime("%Y-%m-%d %H:%M:%S"), "new", (t + timedelta(minutes=3)).replace(tzinfo=None)) for i, t in enumerate(times)]
    rows += [(1000 + i, t.strftime("%Y-%m-%dT%H:%M:%SZ"), "new", (t + timedelta(minutes=4)).replace(tzinfo=None)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "id int, date string, source_id string, fetched timestamp")
    catalogue = zones(spark, [("a", "Asia/Tokyo"), ("b", "America/New_York"), ("c", "UTC")])
    out = T.normalize_timestamps(df, value="date", fetched="fetched", key="source_id", zones=catalogue, zone_key="source_id", zone="tz").collect()
    assert all(r["ts_second"] == int(times[r["id"] % 1000].timestamp()) for r in out) and len(out) == 240


def test_estimates_agree_with_declared_zones(spark, tables):
    rows = T.p3_estimated_zones(spark, tables.replace("sf0.001", "sf0.01")).collect()
    enough = [r for r in rows if r["readings"] >= 5]
    assert len(enough) > 20 and sum(r["same"] == r["readings"] for r in enough) >= 0.9 * len(enough)


def test_null_key_empty_table_repeats_and_clash(spark):
    out = normalized(spark, ["2025-10-01T00:00:00Z", "2025-10-01T00:00:00Z", None], key=None).collect()
    assert len(out) == 3 and [r["ts_second"] is None for r in sorted(out, key=lambda r: r["id"])] == [False, False, True]
    empty = spark.createDataFrame([], "id int, date string, source_id string, fetched timestamp")
    assert T.normalize_timestamps(empty, value="date", fetched="fetched", key="source_id", zones=zones(spark), zone_key="source_id", zone="tz").count() == 0
    with pytest.raises(ValueError):
        T.parse_times(empty.withColumn("ts_local", F.lit(1)), "date", "fetched")


def test_tables(spark, tables):
    rows = T.p3_found(spark, tables).collect()
    assert len(rows) == len({r["article_id"] for r in rows}) > 100
