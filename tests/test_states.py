"""Mergeable states against one pass, updates that read new files only, and frequent values."""

from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import functions as F

from timberline import sources
from timberline.operators import daily, frequent, messages, states, usage
from timberline.plans import jobs
from timberline.sources import manifest

TRIP = "tpep_pickup_datetime timestamp_ntz, trip_distance double, mta_tax double, fare_amount double, tip_amount double, passenger_count long"


def trips(spark, seed, count, days=3):
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        time = datetime(2021, draw.randint(1, 2), draw.randint(1, days), draw.randrange(24))
        rows.append((time, draw.choice([None, draw.random() * 9]), draw.random(), draw.gauss(20, 9), draw.choice([None, draw.random()]), draw.choice([None, 1, 2, 5])))
    rows.append((None, 1.0, 1.0, 1.0, 1.0, 1))
    return spark.createDataFrame(rows, TRIP)


def test_merged_months_equal_one_pass(spark):
    parts = [trips(spark, seed, 700) for seed in range(4)]
    merged = states.merged_days(states.daily_states(parts[0]).unionByName(states.daily_states(parts[1])))
    for part in parts[2:]:
        merged = states.merged_days(merged.unionByName(states.daily_states(part)))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    want = daily.daily_summary(every, 2021).collect()
    got = daily.by_day(states.days_of(merged, 2021)).collect()
    assert len(got) == len(want) == 6 and list(got[0].asDict()) == list(want[0].asDict())
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert abs(a.mean_trip_distance - b.mean_trip_distance) < 1e-9 and a.mean_passenger_count == b.mean_passenger_count
        assert (a.max_mta_tax, a.min_tip_amount, a.q95_fare_amount) == (b.max_mta_tax, b.min_tip_amount, b.q95_fare_amount)


def test_rank_of_a_sketched_quantile(spark):
    """One day with 60,000 trips in 7 parts: the sketch is far smaller, and its quantile's rank is close."""
    one = spark.range(60_000).select(
        F.lit("2021-01-01 10:00:00").cast("timestamp_ntz").alias("tpep_pickup_datetime"), F.rand(1).alias("trip_distance"), F.rand(2).alias("mta_tax"),
        (F.xxhash64("id") % 1_000_000).cast("double").alias("fare_amount"), F.rand(4).alias("tip_amount"), F.lit(1).alias("passenger_count"), (F.col("id") % 7).alias("part"),
    )
    parts = [states.daily_states(one.where(F.col("part") == i)) for i in range(7)]
    merged = parts[0]
    for part in parts[1:]:
        merged = states.merged_days(merged.unionByName(part))
    value = states.days_of(merged, 2021).first().q95_fare_amount
    assert merged.select(F.octet_length("fares")).first()[0] < 60_000
    rank = one.where(F.col("fare_amount") <= value).count() / 60_000
    assert abs(rank - 0.95) < 0.004


def test_days_without_values(spark):
    rows = [(datetime(2021, 1, 1), None, None, None, None, None)]
    row = states.days_of(states.daily_states(spark.createDataFrame(rows, TRIP)), 2021).first()
    assert row.num_trips == 1 and row.mean_trip_distance is None and row.q95_fare_amount is None and row.mean_passenger_count is None
    assert states.days_of(states.daily_states(spark.createDataFrame([], TRIP)), 2021).collect() == []


def test_months_are_stored_and_replaced(spark, tmp_path):
    for name, seed in (("a", 1), ("b", 2), ("a", 3)):
        path = f"{tmp_path}/in-{name}-{seed}"
        trips(spark, seed, 300).write.parquet(path)
        jobs.add_trips(spark, [path], f"{tmp_path}/state", name)
    jobs.daily_from_states(spark, f"{tmp_path}/state", f"{tmp_path}/out", 2021)
    got = spark.read.option("header", True).csv(f"{tmp_path}/out/daily_summary")
    assert got.agg(F.sum(F.col("num_trips").cast("long"))).first()[0] == 600


def test_bitmaps(spark):
    apps = [f"application_{c}_{i:04d}" for c in (11, 12) for i in range(0, 70_000, 7 if c == 11 else 9)]
    halves = [spark.createDataFrame([(a,) for a in part], "application_id string") for part in (apps[: len(apps) * 2 // 3], apps[len(apps) // 3 :])]
    merged = states.merged_bitmaps(states.application_bitmaps(halves[0]).unionByName(states.application_bitmaps(halves[1])))
    got = {row.cluster_id: row.num_applications for row in states.counts_of(merged).collect()}
    assert got == {"11": 10_000, "12": 7_778}
    # Buckets of 32,768 numbers begin with 1; number 0 has one of its own.
    assert merged.count() == 2 * 4


# --- updates


def write_log(root, app, container, lines):
    folder = root / f"application_{app}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"container_{app}_01_{container:06d}.log").write_text("".join(line + "\n" for line in lines))


def line(second, app):
    return f"17/03/29 10:00:{second:02d} INFO a.B: start of application_{app}"


def test_update_reads_new_files_only(spark, tmp_path):
    logs, state = tmp_path / "logs", str(tmp_path / "state")
    write_log(logs, "1_0001", 1, [line(5, "1_0001"), line(9, "1_0001")])
    write_log(logs, "1_0002", 1, ["no name"])
    assert jobs.update_usage(spark, str(logs), state) == 2
    assert jobs.update_usage(spark, str(logs), state) == 0
    assert manifest.latest(spark, state) == 1
    # One more folder, a file with an empty line, and a file that has grown.
    write_log(logs, "2_0001", 1, [line(1, "1_0001"), line(30, "2_0001")])
    write_log(logs, "2_0002", 1, [""])
    write_log(logs, "1_0002", 1, ["no name", line(20, "1_0002")])
    files = manifest.listing(spark, str(logs))
    stored = spark.read.parquet(f"{manifest.version_path(state, 1)}/files")
    fresh = sorted(row.file_path.rsplit("/", 2)[1] for row in manifest.new_files(files, stored).collect())
    assert fresh == ["application_1_0002", "application_2_0001", "application_2_0002"]
    assert jobs.update_usage(spark, str(logs), state) == 3
    lines = sources.read_logs(spark, str(logs))
    want = usage.pad(sources.app_catalog(sources.file_inventory(spark, str(logs))), usage.timeline(lines))
    assert sorted(map(str, usage.padded_of(jobs.usage_of(spark, state)).collect())) == sorted(map(str, want.collect()))


def test_a_version_without_its_marker_is_passed_over(spark, tmp_path):
    logs, state = tmp_path / "logs", tmp_path / "state"
    write_log(logs, "1_0001", 1, [line(5, "1_0001")])
    (state / "version=1" / "overview").mkdir(parents=True)
    assert manifest.latest(spark, str(state)) == 0
    assert jobs.update_usage(spark, str(logs), str(state)) == 1
    assert manifest.latest(spark, str(state)) == 1


def test_paths_come_in_chunks(spark):
    files = spark.createDataFrame([(f"f{i}",) for i in range(7)], "file_path string")
    assert [len(x) for x in manifest.chunks(files, 3)] == [3, 3, 1]


# --- frequent values


def test_frequent_values_against_counting(spark):
    draw = random.Random(4)
    rows = [(f"common {min(int(draw.expovariate(0.2)), 30)}",) for _ in range(3000)] + [(None,)] * 50
    many = spark.createDataFrame(rows, "v string").unionByName(spark.range(200_000).select(F.concat(F.lit("rare "), "id").alias("v")))
    for cells in (16, frequent.CELLS):
        got = [tuple(row) for row in frequent.top(many, F.col("v"), "v", 20, cells).collect()]
        want = many.groupBy("v").count().orderBy(F.desc("count"), F.asc_nulls_first("v")).limit(20)
        assert got == [tuple(row) for row in want.collect()]


def test_few_values(spark, lines):
    table = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    assert [tuple(row) for row in frequent.top(table, F.col("v"), "v", 5).collect()] == [("a", 2), ("b", 1)]
    assert frequent.top(table.limit(0), F.col("v"), "v", 5).collect() == []
    some = lines("17/03/29 10:00:00 INFO a: x", "17/03/29 10:00:00 INFO a: y", "none")
    assert messages.frequent_components(some).collect() == messages.components(some).collect()
