import datetime as dt
import zoneinfo
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fieldreel.operators.timestamps import distinct_histories, estimate_histories, estimate_zones, to_utc

DENVER = "America/Denver"
CASES = [
    ("2022-03-04", DENVER, "2022-03-04T07:00:00"), ("2022:03:04 05:06:07", None, "2022-03-04T05:06:07"), ("20220304", None, "2022-03-04T00:00:00"),
    ("03/04/2022", None, "2022-03-04T00:00:00"), ("2022/3/4", None, "2022-03-04T00:00:00"), ("03.04.2022 16:45", None, "2022-04-03T16:45:00"),
    ("06/20/2024 12:49 AM", None, "2024-06-20T00:49:00"), ("06/20/2024 12:49 pm", None, "2024-06-20T12:49:00"), ("30 Jul 2022", None, "2022-07-30T00:00:00"),
    ("January 17, 2021", None, "2021-01-17T00:00:00"), ("Thu, 28 Sep 2023 12:17:43 -0600", None, "2023-09-28T18:17:43"), ("20 July 2021, 10:54:29", None, "2021-07-20T10:54:29"),
    ("Sep 27, 2025 9:02:56 PM MDT", None, "2025-09-28T03:02:56"), ("2022-05-06 03:45:04 America/Los_Angeles", None, "2022-05-06T10:45:04"),
    ("2024-12-27T19:39:25-07:00[America/Denver]", None, "2024-12-28T02:39:25"), ("2024-12-27T19:39:25+01:00[America/Denver]", DENVER, "2024-12-27T18:39:25"),
    ("  2024-08-29t06:13z ", DENVER, "2024-08-29T06:13:00"), ("20241029T150119", DENVER, "2024-10-29T21:01:19"), ("20241029T150119Z", DENVER, "2024-10-29T15:01:19"),
    ("2025-07-12 06:07:07,300", None, "2025-07-12T06:07:07.300000"), ("2021-12-05T21:43:13.515337909Z", None, "2021-12-05T21:43:13.515337"), ("2022-12-06T22:06:53-07", None, "2022-12-07T05:06:53"),
    ("1739559648", DENVER, "2025-02-14T19:00:48"), ("1689549550593", None, "2023-07-16T23:19:10.593000"), ("1761337541702257", None, "2025-10-24T20:25:41.702257"),
    ("2021-11-07 01:30:00", DENVER, "2021-11-07T07:30:00"), ("2021-03-14 02:30:00", DENVER, "2021-03-14T09:30:00"), ("1899-01-02", None, "1899-01-02T00:00:00"), ("2024-02-29", None, "2024-02-29T00:00:00"),
    ("2022-01-02T03:04:05", "Not/AZone", "2022-01-02T03:04:05"),
]
NOTHING = ["2022-02-29T10:00:00Z", "2024-06-11T25:10:00Z", "2025-04-31 06:00:00", "0000:00:00 00:00:00", "2024-13-05", "TBD", "early May", "summer 2023", "day 3", "", "  ", "----", "13/13 PM", "06/20/2024 13:49 PM", "2022-01-02 03:04:05 Nowhere/City", "123456789012", "2022-01-02T03:04:60", None]


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_formats_whatever_the_session(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        rows = [(v, z) for v, z, _ in CASES] + [(v, None) for v in NOTHING]
        got = {(r.v, r.z): r.utc_us for r in to_utc(spark.createDataFrame(rows, "v string, z string"), "v", "z").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = {(v, z): round(datetime.fromisoformat(t).replace(tzinfo=UTC).timestamp() * 1e6) for v, z, t in CASES} | {(v, None): None for v in NOTHING}
    assert got == want


def test_empty_and_clashing_names(spark):
    df = spark.createDataFrame([], "v string, z string, p int, epoch int")
    assert to_utc(df, "v", "z").columns == ["v", "z", "p", "epoch", "utc_us"]


def test_estimated_zone_is_the_true_one(spark):
    rows = [("cam", 1_600_000_000_000_000 + k * 86_400_000_000 * 30, k) for k in range(12)]
    df = spark.createDataFrame(rows, "c string, u long, k int")
    local = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros("u"), DENVER))
    df = df.withColumn("l", local).withColumn("r", F.col("u") + 60_000_000)
    got = estimate_zones(df.union(df), "c", "l", "r", [DENVER, "UTC", "Europe/Berlin", "America/Phoenix", "America/New_York"]).collect()
    assert [(r.clock, r.zone, r.violations) for r in got] == [("cam", DENVER, 0)]


def test_history_of_offsets_is_estimated_from_written_offsets(spark):
    zone = zoneinfo.ZoneInfo(DENVER)
    rows = []
    for k in range(60):
        at = dt.datetime(2023, 1, 3, 12, tzinfo=dt.UTC) + dt.timedelta(days=17 * k)
        rows.append(("a", int(at.timestamp()) * 1_000_000, int(at.astimezone(zone).utcoffset().total_seconds()) // 60))
    rows += [("a", rows[0][1], 330), ("a", rows[5][1], 60), ("b", rows[0][1], 0), (None, 5, 0), ("c", None, 0), ("d", 5, None)]
    got = {r.clock: r for r in estimate_histories(spark.createDataFrame(rows, "c string, u long, o int"), "c", "u", "o").collect()}
    assert set(got) == {"a", "b"} and (got["a"].violations, got["a"].rows) == (2, 62)
    pick = zoneinfo.ZoneInfo(got["a"].zone)
    assert all(dt.datetime.fromtimestamp(u / 1e6, dt.UTC).astimezone(pick).utcoffset() == dt.datetime.fromtimestamp(u / 1e6, dt.UTC).astimezone(zone).utcoffset() for c, u, o in rows[:60])
    assert estimate_histories(spark.createDataFrame([], "c string, u long, o int"), "c", "u", "o").count() == 0
    assert distinct_histories([DENVER, "America/Boise", "UTC"], dt.datetime(2023, 1, 1, tzinfo=dt.UTC), dt.datetime(2024, 1, 1, tzinfo=dt.UTC)) == ["America/Boise", "UTC"]
