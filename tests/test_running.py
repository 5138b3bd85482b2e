"""Running sums, sweep lines and entries of several lines against plain Python, and how they are spread over tasks."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from timberline import sources
from timberline.operators import entries, levels, running, small, sweep


def spread(df, spark) -> Counter:
    """Rows of each partition of a table of ``running.parted``."""
    return Counter(row[running.PART] for row in df.select(running.PART).collect())


@pytest.fixture
def many_parts(spark):
    """Partitions as they are, as on a table that is too large to merge them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_sums_before(spark, many_parts):
    draw = random.Random(1)
    rows = [("hot" if draw.random() < 0.7 else draw.choice(["a", "b", None]), i, draw.randint(-3, 9)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at int, n int").repartition(5)
    got = {(row.k, row.at): row.before for row in running.sums_before(df, ["k"], ["at"], "n", "before").collect()}
    want, total = {}, Counter()
    for k, at, n in rows:
        want[k, at] = total[k]
        total[k] += n
    assert got == want


def test_a_large_group_is_spread(spark, many_parts):
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("at"))
    parts = spread(running.parted(df, ["k"], ["at"], "test"), spark)
    assert len(parts) >= 6 and max(parts.values()) < 2000


def test_scan_in_both_directions(spark, many_parts):
    rows = [(k, at) for k in "ab" for at in range(0, 600, 3)]
    kept = running.parted(spark.createDataFrame(rows, "k string, at int"), ["k"], ["at"], "test")
    columns = {"last": (F.max, "at", running.BEFORE), "next": (F.min, "at", running.AFTER), "least": (F.min, "at", running.BEFORE)}
    for row in running.scanned(kept, ["k"], ["at"], columns).collect():
        assert row.last == (row.at - 3 if row.at else None)
        assert row.next == (row.at + 3 if row.at < 597 else None)
        assert row.least == (0 if row.at else None)


def test_frequent_line_is_sampled_from_parts(spark, many_parts):
    """A third of all lines are equal and lie in one file: they are one row of the table that is put in order."""
    lines = [("f", "INFO the frequent line")] * 1000 + [("f", f"INFO line {i}") for i in range(1000)] + [("g", f"WARN {i}") for i in range(1000)]
    df = spark.createDataFrame(lines, "file_path string, value string").repartition(6)
    drawn = levels.sample_by_text(df, 300).collect()
    assert len(drawn) == 300
    equal = sum(row.log_entry == "INFO the frequent line" for row in drawn)
    assert 60 < equal < 140
    plan = levels.sample_by_text(df, 30)._jdf.queryExecution().toString()
    # Windows run over counts of texts and over totals of partitions only.
    assert "windowspecdefinition(file_path" in plan and "row_number" not in plan


def brute_concurrency(tasks):
    steps = defaultdict(Counter)
    for app, start, end in tasks:
        if start is not None and end is not None and start < end:
            steps[app][start] += 1
            steps[app][end] -= 1
    out = []
    for app, own in steps.items():
        times, open_ = sorted(own), 0
        for a, b in zip(times, times[1:]):
            open_ += own[a]
            out.append((app, a, b, open_))
    return sorted(out)


def test_concurrency(spark, many_parts):
    draw = random.Random(2)
    tasks = [("hot" if draw.random() < 0.8 else f"a{draw.randrange(4)}", (s := draw.randrange(500)), s + draw.randrange(-3, 60)) for _ in range(700)]
    tasks += [("none", None, 5), ("none", 5, None), ("none", 5, 5), ("one", 1, 4), ("one", 4, 6), ("one", 1, 4)]
    df = spark.createDataFrame(tasks, "application_id string, s long, f long")
    for name, c in (("start_time", "s"), ("finish_time", "f")):
        df = df.withColumn(name, (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col(c).cast("decimal(18,6)"))))
    busy = sweep.concurrency(df)
    seconds = lambda c: F.expr(f"cast(cast({c} - timestamp_ntz'2024-01-01' as interval second) as long)")
    got = [tuple(row) for row in busy.select("application_id", seconds("time_from"), seconds("time_to"), "running").collect()]
    want = brute_concurrency(tasks)
    assert sorted(got) == want
    top = {row.application_id: row for row in sweep.peaks(busy).withColumn("peak_from", seconds("peak_from")).collect()}
    for app in {row[0] for row in want}:
        own = [row for row in want if row[0] == app]
        assert top[app].peak == max(row[3] for row in own)
        assert top[app].peak_from == min(row[1] for row in own if row[3] == top[app].peak)
        assert top[app].busy_seconds == sum(b - a for _, a, b, n in own if n)


def test_coverage(spark, many_parts):
    draw = random.Random(3)
    reads = [(f"p{draw.randrange(3)}" if i % 3 else "hot", draw.randrange(2000), draw.randrange(0, 30)) for i in range(500)]
    reads += reads[:100] + [("p1", 5, None), ("p1", None, 5), ("p2", 0, 400), ("empty", 3, 0), ("p0", -4, 9)]
    df = spark.createDataFrame(reads, "path string, offset long, length long").repartition(4)
    bytes_, splits, total = defaultdict(set), Counter(), Counter()
    for path, start, length in reads:
        splits[path] += 1
        total[path] += length or 0
        if start is not None and length is not None and start >= 0:
            bytes_[path] |= set(range(start, start + length))
    got = {row.path: (row.splits, row.bytes, row.covered) for row in sweep.coverage(df).collect()}
    assert got == {path: (splits[path], total[path], len(bytes_[path])) for path in splits}


# --- entries of several lines


def log_text(seed, count):
    draw = random.Random(seed)
    lines = []
    for i in range(count):
        if draw.random() < 0.4:
            lines.append(f"17/03/29 10:00:{i % 60:02d} {draw.choice(['INFO', 'WARN', 'ERROR'])} part.Of{draw.randrange(3)}: message {i}")
        else:
            lines.append(draw.choice(["\tat x.y(Z.java:1)", "", "Caused by: INFO é", f"  WARN indented {i}", "x" * draw.randrange(200)]))
    return lines


def brute_entries(lines):
    out, head, since = [], (None, None, None), 0
    for line in lines:
        found = line[:17] if line[:2].isdigit() and line[2:3] == "/" else None
        if found:
            head, since = (found, line.split(" ")[2], line.split(" ")[3][:-1]), 0
        out.append((since, *head, line))
        since += 1
    return out


@pytest.mark.parametrize("split_bytes", [40, 700, 1 << 27])
@pytest.mark.parametrize("most_splits", [entries.MOST_SPLITS, 0])
def test_entries_for_any_split(spark, tmp_path, split_bytes, most_splits):
    files = {"application_1_1/a.log": log_text(1, 60), "application_1_2/b.log": [x for x in log_text(2, 40) if x[:2] != "17"], "application_1_2/c.log": log_text(3, 3)}
    for name, lines in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, (split_bytes, 0 if split_bytes < 1000 else 4, 7)):
        spark.conf.set(name, str(value))
    try:
        lines = sources.read_log_splits(spark, str(tmp_path))
        if split_bytes == 40:
            assert lines.select("block").distinct().count() > 20
        got = entries.entries(lines, most_splits).collect()
        sizes = entries.entry_sizes(entries.entries(lines, most_splits)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for name, lines in files.items():
        own = [(row.line_no, row.ts_text, row.level, row.component, row.value) for row in got if row.file_path.endswith(name)]
        assert sorted(own, key=str) == sorted(brute_entries(lines), key=str)
    every = [row for lines in files.values() for row in brute_entries(lines) if row[1]]
    assert sum(row.entries for row in sizes) == sum(row[0] == 0 for row in every)
    assert sum(row.lines for row in sizes) == len(every)


def test_no_lines(spark):
    empty = spark.createDataFrame([], "file_path string, block long, value string")
    assert entries.entries(empty).collect() == []


# --- small tables


def test_tables_are_counted_before_they_are_broadcast(spark):
    left, right = spark.range(50).withColumnRenamed("id", "k"), spark.range(20).withColumnRenamed("id", "k").withColumn("x", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows, joined in ((20, "BroadcastHashJoin"), (19, "SortMergeJoin")):
            found = left.join(small.bounded(right, rows), "k")
            assert found.count() == 20
            assert joined in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small.fits(right, 20) and not small.fits(right, 19)
    with pytest.raises(ValueError):
        small.bounded(right, 19, strict=True)


def test_a_caller_cannot_have_a_large_table_broadcast(spark, lines):
    table = lines("17/03/29 10:00:00 INFO a: b")
    for most, hint in ((5, True), (4, False)):
        assert ("ResolvedHint" in levels.counts_of(levels.groups(table), levels.LEVELS)._jdf.queryExecution().analyzed().toString()) is True
        found = small.made_small(spark.range(5), 5, most)
        assert ("ResolvedHint" in found._jdf.queryExecution().analyzed().toString()) is hint
