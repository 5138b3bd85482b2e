"""Results do not depend on the layout of the input, nor on one key that holds much of it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from timberline import sources
from timberline.operators import daily, durations, levels, messages, usage
from timberline.plans import standins
from timberline.plans.catalog import rounded


def rows(df):
    return sorted((tuple(row) for row in rounded(df).collect()), key=str)


LOG_OPERATORS = {
    "report": levels.report,
    "share": levels.share,
    "sample": lambda lines: levels.sample(lines, key="event_id"),
    "timeline": usage.timeline,
    "timeline_by_path": lambda lines: usage.timeline(lines, by="path"),
    "summary": lambda lines: usage.cluster_summary(sources.app_catalog(sources.files_of(lines)), usage.timeline(lines)),
    "histogram": lambda lines: durations.histogram(durations.durations(usage.timeline(lines))),
    "density": lambda lines: durations.density(durations.durations(usage.timeline(lines))),
    "task_times": lambda lines: messages.task_time_by_app(messages.task_times(messages.task_events(lines))),
    "memory": messages.memory_blocks,
}


@pytest.mark.parametrize("name", LOG_OPERATORS)
def test_one_or_eight_partitions(spark, small_dir, name):
    lines = standins.logs(spark, small_dir)
    one, eight = (rows(LOG_OPERATORS[name](lines.repartition(n))) for n in (1, 8))
    assert one == eight
    assert one


def test_trips_in_one_or_eight_partitions(spark, small_dir):
    trips = standins.trips(spark, small_dir)
    one, eight = (rows(daily.daily_summary(trips.repartition(n), 1997)) for n in (1, 8))
    assert one == eight


@pytest.fixture
def skewed(spark):
    """Thirty thousand lines, half of them in one file of one application."""
    app = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 40 + 1)
    name = F.format_string("%d_%04d", (app % 3).cast("int"), app.cast("int"))
    second = F.format_string("%02d:%02d:%02d", (F.col("id") / 3600).cast("int"), (F.col("id") / 60 % 60).cast("int"), (F.col("id") % 60).cast("int"))
    return spark.range(30000).select(
        F.concat(F.lit("file:/l/application_"), name, F.lit("/container_"), name, F.lit("_01_000001.log")).alias("file_path"),
        F.concat(F.lit("17/03/29 "), second, F.lit(" INFO a: of application_"), name).alias("value"),
        name.alias("name"),
        second.alias("second"),
    )


def test_one_hot_application(skewed):
    want = {
        (row.name, row.first, row.last)
        for row in skewed.groupBy("name").agg(F.min("second").alias("first"), F.max("second").alias("last")).collect()
    }
    for by in ("line", "path"):
        got = usage.timeline(skewed.select("file_path", "value"), by).collect()
        assert {
            (row.application_id.removeprefix("application_"), f"{row.start_time:%H:%M:%S}", f"{row.end_time:%H:%M:%S}")
            for row in got
        } == want
        assert len(got) == len(want)


def test_totals_stay_whole(skewed):
    lines = skewed.select("file_path", "value")
    assert messages.inventory(lines).collect()[0].lines == 30000
    assert levels.totals(lines).collect()[0].lines_with_level == 30000


def test_invariants(spark, small_dir):
    lines = standins.logs(spark, small_dir)
    catalog = sources.app_catalog(sources.files_of(lines))
    padded = usage.pad(catalog, usage.timeline(lines))
    assert padded.count() == catalog.count()
    assert padded.filter("start_time > end_time").count() == 0
    d = durations.durations(padded)
    assert durations.histogram(d).agg(F.sum("count")).collect()[0][0] == d.count()
