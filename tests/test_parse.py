from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timberline.functions import parse, text


def one(df, column):
    return df.select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize(
    "line, bounded, unbounded",
    [
        ("INFORMATION x ERROR: y", "ERROR", "INFO"),
        ("17/03/29 10:04:43 INFO a: b", "INFO", "INFO"),
        ("17/03/29 10:04:43 ERROR a: later WARN", "ERROR", "ERROR"),
        ("no level at all", "", ""),
        ("info in small letters", "", ""),
        ("a_DEBUG_b", "", "DEBUG"),
        ("", "", ""),
    ],
)
def test_level(lines, line, bounded, unbounded):
    df = lines(line)
    assert one(df, parse.level()) == bounded
    assert one(df, parse.level(bounded=False)) == unbounded


def test_level_of_header_only(lines):
    assert one(lines("17/03/29 10:04:43 INFO a: saw ERROR"), parse.level(header_only=True)) == "INFO"
    assert one(lines("  continued, saw ERROR"), parse.level(header_only=True)) == ""


@pytest.mark.parametrize(
    "line, ts_text, ts",
    [
        ("17/03/29 10:04:43 INFO a: b", "17/03/29 10:04:43", dt.datetime(2017, 3, 29, 10, 4, 43)),
        ("2017-03-29 10:04:43 INFO a: b", "2017-03-29 10:04:43", dt.datetime(2017, 3, 29, 10, 4, 43)),
        ("17/03/29  10:04:43 INFO a: b", "17/03/29  10:04:43", None),
        ("17/03/29\t10:04:43 INFO a: b", "17/03/29\t10:04:43", None),
        ("17/13/99 10:04:43 WARN a: b", "17/13/99 10:04:43", None),
        ("17/02/30 10:04:43 WARN a: b", "17/02/30 10:04:43", None),
        ("16/02/29 23:59:59 WARN a: b", "16/02/29 23:59:59", dt.datetime(2016, 2, 29, 23, 59, 59)),
        ("17/03/29 24:00:00 WARN a: b", "17/03/29 24:00:00", None),
        ("17/03/29 10:60:00 WARN a: b", "17/03/29 10:60:00", None),
        (" 17/03/29 10:04:43 INFO a: b", "", None),
        ("at 17/03/29 10:04:43", "", None),
        ("", "", None),
    ],
)
def test_time(lines, line, ts_text, ts):
    df = lines(line)
    assert one(df, parse.ts_text()) == ts_text
    assert one(df, parse.ts()) == ts
    assert one(df, parse.parse_ts(parse.ts_text())) == ts


def test_time_equals_pattern_parser(spark):
    """The tolerant cast accepts the same texts as parsing by the two patterns."""
    two = st.integers(0, 99).map("{:02d}".format)
    gap = st.sampled_from([" ", "  ", "\t"])
    short = st.tuples(two, two, two, gap, two, two, two).map(lambda p: f"{p[0]}/{p[1]}/{p[2]}{p[3]}{p[4]}:{p[5]}:{p[6]}")
    day = st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2099, 12, 31)).map(lambda d: d.strftime("%Y-%m-%d %H:%M:%S"))
    near = st.tuples(st.integers(1, 13), st.integers(28, 32), st.integers(22, 25), st.integers(58, 61))
    edge = near.map(lambda p: f"17/{p[0]:02d}/{p[1]:02d} {p[2]:02d}:{p[3]:02d}:{p[3]:02d}")
    texts = []

    @settings(max_examples=400, database=None, deadline=None)
    @given(st.one_of(short, day, edge))
    def collect(t):
        texts.append(t)

    collect()
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    by_pattern = F.coalesce(
        F.try_to_timestamp("value", F.lit("yy/MM/dd HH:mm:ss")), F.try_to_timestamp("value", F.lit("yyyy-MM-dd HH:mm:ss"))
    ).cast("timestamp_ntz")
    checked = df.select("value", parse.ts().alias("a"), parse.parse_ts("value").alias("b"), by_pattern.alias("c"))
    assert checked.filter("NOT (a <=> c) OR NOT (b <=> c)").collect() == []
    assert checked.filter("a IS NOT NULL").count() > 50


def test_ids(lines):
    df = lines("17/03/29 10:04:43 INFO a: start application_1485248649253_0052 then application_1_2")
    assert one(df, parse.app_id("value")) == "application_1485248649253_0052"
    assert one(df, parse.cluster_id("value")) == "1485248649253"
    assert one(df, parse.app_number("value")) == "0052"
    assert one(lines("application_x_y"), parse.app_id("value")) == ""


def test_container(lines):
    path = "s3a://b/data/application_1485248649253_0052/container_1485248649253_0052_01_000001.log"
    df = lines((path, ""))
    assert one(df, parse.container_id()) == "container_1485248649253_0052_01_000001"
    assert [one(df, parse.container_part("file_path", i)) for i in (1, 2, 3, 4)] == ["1485248649253", "0052", "01", "000001"]
    assert one(df, parse.container_role()) == "ApplicationMaster"
    assert one(lines((path.replace("000001", "000002"), "")), parse.container_role()) == "Executor"
    assert one(lines(("file:/a/README", "")), parse.container_role()) is None


def test_cluster_start_in_any_zone(spark):
    df = spark.createDataFrame([("1485248649253",), ("x",), ("",)], "cluster_id string")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [row.x for row in df.select(parse.cluster_start().alias("x")).collect()]
            assert got == [dt.datetime(2017, 1, 24, 9, 4, 9, 253000), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_component_and_header(lines):
    df = parse.with_header(lines("17/03/29 10:04:43 INFO executor.Executor: Running task: 1", "    at frame"))
    first, second = df.collect()
    assert (first.ts_text, first.level, first.component) == ("17/03/29 10:04:43", "INFO", "executor.Executor")
    assert (second.ts_text, second.level, second.component, second.message) == ("", "", "", "    at frame")


def test_time_text_and_back(spark):
    df = spark.createDataFrame([("2017-03-29 10:04:43",), ("",), ("bad",), (None,)], "t string")
    times = df.select(text.text_time("t").alias("t"))
    assert [row.t for row in times.collect()] == [dt.datetime(2017, 3, 29, 10, 4, 43), None, None, None]
    assert [row.t for row in text.times_as_text(times).collect()] == ["2017-03-29 10:04:43", "", "", ""]
