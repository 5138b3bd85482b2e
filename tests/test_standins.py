"""Folders that the stand-ins write: tasks follow the number of folders, and large folders are split."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from timberline.plans import standins

USERS, LINES = 200, 400


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    """Events of many users with a line or two in each container, and one container with LINES more."""
    folder = str(tmp_path_factory.mktemp("events"))
    few = spark.range(USERS * 4).select("id", (F.col("id") / 4).cast("long").alias("user_id"))
    one = spark.range(10_000, 10_000 + 4 * LINES, 4).select("id", F.lit(3).cast("long").alias("user_id"))
    rows = few.unionByName(one).selectExpr("id AS event_id", "timestamp_seconds(1700000000 + id) AS ts", "user_id", "IF(id % 3 = 0, 'error', 'view') AS event_type")
    rows.write.parquet(f"{folder}/events.parquet")
    return folder


def written(root: str) -> list[tuple[str, str]]:
    """Folder and task of each text file."""
    return [(folder, name.split("-")[1]) for folder, _, names in os.walk(root.removeprefix("file:")) for name in names if name.startswith("part-")]


@pytest.mark.parametrize("write, of", [(standins.log_folder, "value"), (standins.trace_folder, "entry")])
def test_tasks_follow_folders(spark, many_users, monkeypatch, write, of):
    monkeypatch.setattr(standins, "TASK_FOLDERS", 20, raising=False)
    monkeypatch.setattr(standins, "TASK_LINES", 100, raising=False)
    monkeypatch.setattr(standins, "_folders", {})
    root = write(spark, many_users)
    files = written(root)
    assert len({folder for folder, _ in files}) == USERS * 4
    assert max(Counter(task for _, task in files).values()) <= 3 * 20
    # A folder of log lines is split; a file with traces is one, as its lines have an order.
    most = max(Counter(folder for folder, _ in files).values())
    assert 1 < most <= 5 if of == "value" else most == 1
    got = spark.read.option("recursiveFileLookup", "true").text(root)
    events = standins.table(spark, many_users, "events")
    want = spark.sql(standins.TRACED + f"SELECT explode(split({of}, chr(10))) AS value FROM t", events=events)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
