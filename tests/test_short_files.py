"""Many short files: they are written and read by few tasks, and opened once."""

from __future__ import annotations

import os

import pytest

from tests.test_running import brute_entries, log_text
from timberline import sources
from timberline.operators import entries
from timberline.plans import standins

SHORT_FILES = 160
LIMITS = {"spark.sql.files.maxPartitionBytes": str(64 << 10), "spark.sql.files.openCostInBytes": str(16 << 10)}


@pytest.fixture
def limits(spark):
    before = {name: spark.conf.get(name) for name in LIMITS}
    for name, value in LIMITS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def files(tmp_path):
    """Lines of each file: short ones of several lengths, one without lines, and one of many splits."""
    made = {f"application_1_1/container_1_1_01_{i:06d}.log": log_text(i, [3, 30, 150][i % 3]) for i in range(SHORT_FILES)}
    made |= {"application_1_1/none.log": [], "application_1_2/long.log": log_text(9, 8000), "application_1_2/open.log": ["\tat x"] * 8000}
    for name, lines in made.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    return made


@pytest.mark.parametrize("short, most_splits, glob", [((200, 2000), entries.MOST_SPLITS, sources.BELOW), ((200, 2000), 0, "*"), (sources.logs.SHORT, 0, sources.BELOW)])
def test_short_files_are_entries_as_well(spark, files, tmp_path, limits, monkeypatch, short, most_splits, glob):
    monkeypatch.setattr(sources.logs, "SHORT", short)
    lines = sources.read_log_splits(spark, str(tmp_path), glob)
    got = {}
    for row in entries.entries(lines, most_splits).collect():
        got.setdefault(row.file_path.split(f"{tmp_path}/")[1], []).append((row.line_no, row.ts_text, row.level, row.component, row.value))
    assert {name: sorted(rows, key=str) for name, rows in got.items()} == {name: sorted(brute_entries(x), key=str) for name, x in files.items() if x}


def test_short_files_share_tasks_and_are_opened_once(spark, files, tmp_path, limits, monkeypatch):
    monkeypatch.setattr(sources.logs, "SHORT", (1 << 10, 4 << 10))
    lines = sources.read_log_splits(spark, str(tmp_path), sources.BELOW)
    whole, parts = lines.filter("whole"), lines.filter("NOT whole")
    assert whole.select("file_path").distinct().count() == SHORT_FILES
    assert parts.select("file_path").distinct().count() == 2
    # The first pass of entries reads the long files alone; Spark by itself has four short files in a task here.
    opened = entries.splits(parts).rdd.getNumPartitions()
    assert opened == parts.rdd.getNumPartitions() < 20
    monkeypatch.setattr(sources.logs, "SHORT_TASKS", 1)
    few = sources.read_log_splits(spark, str(tmp_path), sources.BELOW).filter("whole")
    assert few.rdd.getNumPartitions() < SHORT_FILES / 5
    assert few.count() == whole.count()


def test_settings_that_change_after_reading_are_an_error(spark, files, tmp_path, limits):
    lines = sources.read_log_splits(spark, str(tmp_path), sources.BELOW)
    for name in LIMITS:
        spark.conf.set(name, "500")
    with pytest.raises(Exception, match="was to be one split"):
        entries.entries(lines).collect()


def test_few_tasks_list_folders(spark, tmp_path, monkeypatch):
    for i in range(100):
        (tmp_path / f"container={i}").mkdir()
        (tmp_path / f"container={i}" / "part-0.txt").write_text("x\n")
    monkeypatch.setattr(sources.logs, "LISTING_TASKS", 2)
    before = spark.conf.get(sources.logs.LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert sources.read_log_splits(spark, str(tmp_path), sources.BELOW).filter("whole").count() == 100
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(k) for job in tracker.getJobIdsForGroup("listing") for k in tracker.getJobInfo(job).stageIds]
    assert max(stage.numTasks for stage in stages if stage) < 100
    assert spark.conf.get(sources.logs.LISTING) == before


def content(root: str) -> dict[tuple[str, str], bytes]:
    """Bytes by folder and task."""
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if not name.startswith((".", "_")):
                with open(f"{folder}/{name}", "rb") as file:
                    found[os.path.relpath(folder, root), name.split("-")[1]] = file.read()
    return found


def test_local_files_are_those_that_spark_writes(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "IF(id % 7 = 3, NULL, concat('container_', id % 50)) AS container", "IF(id % 11 = 5, NULL, repeat(concat('é', id, IF(id % 4 = 0, '\n\t', '')), CAST(id % 3 AS INT))) AS value", "id"
    )
    rows = rows.repartition(5, "container").sortWithinPartitions("container", "id").select("value", "container")
    rows.write.partitionBy("container").text(f"{tmp_path}/spark")
    for folder in ("one", "two"):
        os.makedirs(f"{tmp_path}/{folder}")
        assert standins._write_local(rows, "container", f"{tmp_path}/{folder}") == 4000
        assert content(f"{tmp_path}/{folder}") == content(f"{tmp_path}/spark")
    assert len(content(f"{tmp_path}/spark")) == 51
    assert standins._write_local(rows.limit(0), "container", f"{tmp_path}/one") == 0


def test_same_traces_in_other_stores(spark, small_dir, monkeypatch):
    found = []
    for local in (standins.local_folder, lambda spark, path: None):
        monkeypatch.setattr(standins, "local_folder", local)
        monkeypatch.setattr(standins, "_folders", {})
        root = standins.trace_folder(spark, small_dir).removeprefix("file:")
        found.append({folder: text for (folder, _), text in content(root).items()})
    assert found[0] == found[1] and found[0]
