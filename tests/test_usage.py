from __future__ import annotations

import datetime as dt

import pytest

from timberline import sources
from timberline.operators import usage

CATALOG = "cluster_id string, application_id string, app_number string"
TIMES = "cluster_id string, application_id string, app_number string, start_time timestamp_ntz, end_time timestamp_ntz"


def path(cluster, app, container=1):
    return f"file:/logs/application_{cluster}_{app:04d}/container_{cluster}_{app:04d}_01_{container:06d}.log"


def at(second):
    return dt.datetime(2017, 3, 29, 10, 0, second)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def log(lines):
    return lines(
        (path(1, 1), "17/03/29 10:00:05 INFO a: of application_1_0001"),
        (path(1, 1), "17/03/29 10:00:01 INFO a: names nothing"),
        (path(1, 1), "2017-03-29 10:00:09 INFO a: of application_1_0001"),
        (path(1, 2), "17/03/29 10:00:07 INFO a: of application_1_0001"),
        (path(1, 2), "    no time, of application_1_0002"),
        (path(2, 1), "17/03/29 10:00:03 INFO a: names nothing"),
    )


@pytest.fixture
def catalog(log):
    return sources.app_catalog(sources.files_of(log))


def test_timeline_by_line(log):
    assert rows(usage.timeline(log)) == [
        ("1", "application_1_0001", "0001", at(5), at(9)),
        ("1", "application_1_0002", "0002", None, None),
    ]


def test_timeline_by_path(log):
    assert rows(usage.timeline(log, by="path")) == [
        ("1", "application_1_0001", "0001", at(1), at(9)),
        ("1", "application_1_0002", "0002", at(7), at(7)),
        ("2", "application_2_0001", "0001", at(3), at(3)),
    ]
    with pytest.raises(ValueError):
        usage.timeline(log, by="file")


def test_missing_and_pad(log, catalog):
    times = usage.timeline(log)
    assert rows(usage.missing(catalog, times)) == [("2", "application_2_0001", "0001", None, None)]
    assert rows(usage.pad(catalog, times)) == sorted(rows(times) + rows(usage.missing(catalog, times)), key=str)


def test_applications_outside_the_catalog_stay(log, catalog):
    padded = usage.pad(catalog.filter("cluster_id = '2'"), usage.timeline(log))
    assert [row[1] for row in rows(padded)] == ["application_1_0001", "application_1_0002", "application_2_0001"]


def test_summary_keeps_the_clusters_of_the_catalog(log, catalog):
    times = usage.timeline(log)
    assert rows(usage.cluster_summary(catalog, times)) == [("1", 2, at(5), at(9)), ("2", 1, None, None)]
    assert rows(usage.cluster_summary(catalog.filter("cluster_id = '2'"), times)) == [("2", 1, None, None)]


def test_stats_and_report_of_the_published_counts(spark):
    counts = spark.createDataFrame(
        [("a", 1), ("b", 2), ("c", 1), ("d", 8), ("e", 1), ("f", 181)], "cluster_id string, num_applications long"
    )
    stats = usage.stats(counts).collect()[0]
    assert (stats.clusters, stats.applications, round(stats.avg_applications, 2)) == (6, 194, 32.33)
    assert [line for _, line in sorted(rows(usage.report(counts, heading="Label: x")))] == [
        "Label: x",
        "Total unique clusters: 6",
        "Total applications: 194",
        "Average applications per cluster: 32.33",
        "",
        "Most heavily used clusters:",
        "  Cluster f: 181 applications",
        "  Cluster d: 8 applications",
        "  Cluster b: 2 applications",
        "  Cluster a: 1 applications",
        "  Cluster c: 1 applications",
    ]


def test_empty_stats(spark):
    counts = spark.createDataFrame([], "cluster_id string, num_applications long")
    assert rows(usage.stats(counts)) == [(0, 0, 0.0)]


def test_ties_by_cluster_id(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "cluster_id string, num_applications long")
    assert [row.cluster_id for row in usage.top(counts).collect()] == ["c", "a", "b"]


def test_largest_by_timed_applications(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 2)], "cluster_id string, num_applications long")
    timed = [("a", "application_a_1", "1", at(1), at(2)), ("b", "x", "1", at(1), at(2)), ("b", "y", "2", at(1), None)]
    assert rows(usage.largest(counts, spark.createDataFrame(timed, TIMES))) == [("b", 2, 2)]
    untimed = [("a", "application_a_1", "1", None, None), ("b", "x", "1", None, None)]
    assert rows(usage.largest(counts, spark.createDataFrame(untimed, TIMES))) == [("a", 5, 0)]


def test_largest_knows_clusters_of_the_timeline_only(spark):
    counts = spark.createDataFrame([("a", 5)], "cluster_id string, num_applications long")
    times = spark.createDataFrame([("z", "x", "1", at(1), at(2))], TIMES)
    assert rows(usage.largest(counts, times)) == [("z", 0, 1)]


def test_text_form(log, catalog):
    text = usage.as_text(usage.pad(catalog, usage.timeline(log)))
    assert text.columns == ["cluster_id", "application_id", "start_time", "end_time"]
    assert rows(text)[0] == ("1", "application_1_0001", "2017-03-29 10:00:05", "2017-03-29 10:00:09")
    assert rows(text)[2] == ("2", "application_2_0001", "", "")


def test_catalog_leaves_other_folders_out(spark):
    files = spark.createDataFrame(
        [
            ("file:/d/application_1_0002/a.log",),
            ("file:/d/application_1_0002/README",),
            ("file:/d/application_x_y/a.log",),
            ("file:/d/README",),
            ("file:/d/application_1_0003_old/a.log",),
            ("file:/d/application_1_0004.log",),
            ("file:/d/old_application_1_0005/a.log",),
            ("file:/d/application_1_0006.bak/a.log",),
            ("file:/d/application_9_9/x/application_1_0002/b.log",),
            ("file:/d/app=application_1_0007/b.log",),
        ],
        "file_path string",
    )
    assert rows(sources.app_catalog(files)) == [("1", "application_1_0002", "0002"), ("1", "application_1_0007", "0007")]


def test_overview_is_catalog_and_timeline(log, catalog):
    seen = usage.overview(log)
    owned = sources.app_catalog(sources.files_of(log))
    times = usage.timeline(log)
    assert rows(usage.padded_of(seen)) == rows(usage.pad(owned, times))
    assert rows(usage.missing_of(seen)) == rows(usage.missing(owned, times))
    assert rows(usage.summary_of(seen)) == rows(usage.cluster_summary(owned, times))
    assert rows(usage.largest_of(seen)) == rows(usage.largest(usage.cluster_counts(owned), times))
