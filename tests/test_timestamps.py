"""Instants against a brute-force reading with zoneinfo, and the operator's edge cases."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.timestamps import estimate_zones, normalise_timestamps, not_canonical

CONFIG = "source string, zone string, day_first boolean"
JOBS = "row_id bigint, source string, date_posted string, fetched_at string"


def run(spark, values, zone="America/New_York", day_first=False, source="s"):
    jobs = spark.createDataFrame([(i, source, v, None) for i, v in enumerate(values)], JOBS)
    config = spark.createDataFrame([("s", zone, day_first)], CONFIG)
    return {r.row_id: r.utc_us for r in normalise_timestamps(jobs, config, ["date_posted"]).collect()}


def us(*parts, zone="UTC"):
    t = datetime(*parts, tzinfo=ZoneInfo(zone)).astimezone(timezone.utc)
    return round((t - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


def test_formats(spark):
    ny = "America/New_York"
    cases = {
        "2024-02-10T03:06:57+08:00": us(2024, 2, 9, 19, 6, 57), "2024-02-10T03:06:57-0500": us(2024, 2, 10, 8, 6, 57), "2024-02-09T01:24:06+00": us(2024, 2, 9, 1, 24, 6), "2024-03-12T21:07:03[Europe/Berlin]": us(2024, 3, 12, 20, 7, 3),
        "2024-03-12": us(2024, 3, 12, zone=ny), "03/04/2024 5:06 PM": us(2024, 3, 4, 17, 6, zone=ny), "12/1/24": us(2024, 12, 1, zone=ny), "08-Mar-24 06:02": us(2024, 3, 8, 6, 2, zone=ny), "Wed, 21 Feb 2024 06:14:25 EST": us(2024, 2, 21, 11, 14, 25),
        "9 November 2025, 04:49": us(2025, 11, 9, 4, 49, zone=ny), "1st March 2026": us(2026, 3, 1, zone=ny), "Oct 6, 2025 12:03 am": us(2025, 10, 6, 0, 3, zone=ny), "20240315T214357Z": us(2024, 3, 15, 21, 43, 57), "20240315": us(2024, 3, 15, zone=ny),
        "1707066286": 1707066286 * 10**6, "1707066286672": 1707066286672000, "1707066286672123": 1707066286672123, "1707066286.67": 1707066286670000, "2024-02-15T04:06:55.194627912Z": us(2024, 2, 15, 4, 6, 55, 194627), " 2024-02-15 04:06\t": us(2024, 2, 15, 4, 6, zone=ny),
        "2024-03-10 02:30:00": us(2024, 3, 10, 7, 30), "2024-11-03 01:30:00": us(2024, 11, 3, 5, 30),  # skipped: offset before; twice: the first
    }
    for v in ("", "TBD", "0", "2024-13-40", "31/02/2024", "2023-02-30 10:00:00", "1899-12-30", "2051-01-01 12:00", "0000-00-00", "2024-02-10T25:00:00Z", "2024-02-10T10:00:00[No/Where]", "2024-02-10 10:00 XYZ", "9" * 40, "x" * 5000, "1969-12-31T23:59:59.999Z"):
        cases[v] = -1
    got = run(spark, list(cases))
    assert {v: got[i] for i, v in enumerate(cases)} == cases


def test_day_first_and_mixed_case(spark):
    assert run(spark, ["03/04/2024", "3.4.2024 05:06:07"], "UTC", True) == {0: us(2024, 4, 3), 1: us(2024, 4, 3, 5, 6, 7)}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.datetimes(datetime(2015, 1, 3), datetime(2030, 12, 28)), min_size=5, max_size=20), st.sampled_from(["Europe/London", "Australia/Sydney", "America/Los_Angeles", "Africa/Lagos"]))
def test_local_times_like_zoneinfo(spark, times, zone):
    times = [t.replace(microsecond=0) for t in times]
    got = run(spark, [t.strftime("%Y-%m-%d %H:%M:%S") for t in times], zone)

    def brute(t):
        z = ZoneInfo(zone)
        a = t.replace(tzinfo=z, fold=0)
        return us(*(a - a.utcoffset()).replace(tzinfo=None).timetuple()[:6])

    assert got == {i: brute(t) for i, t in enumerate(times)}


def test_unknown_sources_get_an_estimated_zone(spark):
    """Postings of an unlisted source, local to Nairobi, fetched minutes later by a UTC clock."""
    rows = [(i, "new", (datetime(2024, 5, 1, 9) + timedelta(hours=7 * i)).strftime("%Y-%m-%d %H:%M:%S"), (datetime(2024, 5, 1, 6, 5) + timedelta(hours=7 * i)).strftime("%Y-%m-%dT%H:%M:%SZ")) for i in range(12)]
    jobs = spark.createDataFrame(rows, JOBS)
    out = normalise_timestamps(jobs, spark.createDataFrame([], CONFIG), ["date_posted"]).collect()
    assert {r.row_id: r.utc_us for r in out} == {i: us(2024, 5, 1, 6) + i * 7 * 3600 * 10**6 for i in range(12)}
    pairs = jobs.select("source", F.lit(0).cast("bigint").alias("local_us"), F.lit(None).cast("bigint").alias("seen_us"))
    assert estimate_zones(pairs).count() == 0


def test_edges(spark):
    config = spark.createDataFrame([("s", "UTC", True), ("s", "Europe/Berlin", False)], CONFIG)
    assert normalise_timestamps(spark.createDataFrame([], JOBS), config, ["date_posted", "fetched_at"]).count() == 0
    twice = spark.createDataFrame([(None, None, "2024-01-01T00:00:00Z", None)] * 2 + [(1, "s", None, "2049-05-01T00:00:00Z")], JOBS).withColumn("zone", F.lit("clash")).withColumn("raw", F.lit(1))
    got = sorted(tuple(r) for r in normalise_timestamps(twice, config, ["date_posted", "fetched_at"]).select("field_name", "utc_us").collect())
    assert got == [("date_posted", us(2024, 1, 1))] * 2 + [("fetched_at", -1)]
    kept = not_canonical(normalise_timestamps(twice, config, ["date_posted", "fetched_at"]))
    assert [r.utc_us for r in kept.collect()] == [-1]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_session_zone_does_not_matter(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert run(spark, ["2024-07-01 12:00:00"], "Europe/Berlin") == {0: us(2024, 7, 1, 10)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_the_offset_history_is_found_among_all(spark):
    """Local times with daylight saving, seen a little later: only the history itself keeps them in order that tightly."""
    from datetime import UTC, datetime, timedelta
    from zoneinfo import ZoneInfo

    from tidemark.operators.timestamps import offset_histories

    assert len(offset_histories()) > 90 and {"Africa/Nairobi", "America/New_York", "Asia/Kolkata"} <= set(offset_histories())
    table = []
    for zone in ("America/New_York", "Asia/Kolkata", "Europe/Berlin", "Australia/Sydney"):
        for k in range(300):
            seen = datetime(2023, 1, 1, tzinfo=UTC) + timedelta(hours=61 * k)
            local = (seen - timedelta(minutes=1 + k % 50)).astimezone(ZoneInfo(zone)).replace(tzinfo=UTC)
            table += [(zone, int(local.timestamp()) * 1_000_000, int(seen.timestamp()) * 1_000_000)] * (1 + k % 2)
    got = estimate_zones(spark.createDataFrame(table, "source string, local_us bigint, seen_us bigint")).collect()
    assert {r.source: (r.zone, r.violations, r.n) for r in got} == {z: (z, 0, 450) for z in ("America/New_York", "Asia/Kolkata", "Europe/Berlin", "Australia/Sydney")}
