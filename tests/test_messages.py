from __future__ import annotations

from timberline import sources
from timberline.operators import messages

APP = "application_1485248649253_0052"
CONTAINER = "container_1485248649253_0052_01_000002"


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def test_resource_requests(lines):
    df = lines(
        "17/03/29 10:04:43 INFO YarnAllocator: Will request 16 executor containers, each with 5 cores and 28160 MB memory including 2560 MB overhead",
        "17/03/29 10:04:44 INFO YarnAllocator: Will request 2 executor containers, each with 7 cores and 1024 MB memory",
        "17/03/29 10:04:44 INFO YarnAllocator: Will request many executor containers",
    )
    assert rows(messages.resource_requests(df)) == [(APP, 2, 18, 7, 28160, 2560)]


def test_request_without_overhead(lines):
    df = lines("INFO YarnAllocator: Will request 2 executor containers, each with 7 cores and 1024 MB memory")
    assert rows(messages.resource_requests(df)) == [(APP, 1, 2, 7, 1024, None)]


def test_container_sizes(lines):
    text = "INFO YarnAllocator: Container request (host: Any, capability: <memory:28160, vCores:5>)"
    assert rows(messages.container_sizes(lines(text, text, "capability: <memory:X, vCores:Y>"))) == [(28160, 5, 2)]


def test_tasks(lines):
    df = lines(
        "17/03/29 10:11:10 INFO executor.Executor: Running task 8.0 in stage 1.0 (TID 9)",
        "17/03/29 10:11:15 INFO executor.Executor: Finished task 8.0 in stage 1.0 (TID 9). 2076 bytes result sent to driver",
        "17/03/29 10:11:16 INFO executor.Executor: Running task 38.1 in stage 422.0 (TID 16918)",
        "17/03/29 10:11:20 INFO executor.Executor: Running task 1.0 in stage 2.0 (TID 11)",
        "17/03/29 10:11:19 INFO executor.Executor: Finished task 1.0 in stage 2.0 (TID 11). 1 bytes result sent to driver",
        "17/99/29 10:11:19 INFO executor.Executor: Finished task 5.0 in stage 2.0 (TID 12). 1 bytes result sent to driver",
        "17/03/29 10:11:19 INFO executor.Executor: some task without numbers",
        "17/03/29 10:11:19 INFO executor.Executor: Running task 1.0 in stage 2.0 (TID 99999999999999999999999)",
    )
    events = messages.task_events(df)
    first = [row for row in events.collect() if row.tid == 16918][0]
    assert tuple(first)[:6] == (APP, 422, 38, 1, 16918, "Running")
    assert events.count() == 7
    times = messages.task_times(events)
    assert {(row.tid, row.seconds) for row in times.collect()} == {(9, 5), (16918, None), (11, -1), (12, None), (None, None)}
    assert rows(messages.task_time_by_app(times)) == [(APP, 5, 3, 1, 5.0)]


def test_python_times(lines):
    df = lines(
        "17/02/01 18:32:52 INFO python.PythonRunner: Times: total = 973, boot = -28148, init = 28169, finish = 952",
        "17/03/29 10:11:13 INFO python.PythonRunner: Times: total = 2282, boot = 1190, init = 59, finish = 1033",
        "Times: total = x",
    )
    times = messages.python_times(df)
    assert rows(times) == [(APP, CONTAINER, 2282, 1190, 59, 1033), (APP, CONTAINER, 973, -28148, 28169, 952)]
    assert [row.total for row in messages.first_python_times(times, 1).collect()] == [973]


def test_memory(lines):
    df = lines(
        "17/06/10 15:20:41 INFO storage.MemoryStore: Block broadcast_179_piece0 stored as bytes in memory (estimated size 5.5 KB, free 1155.2 KB)",
        "17/06/10 15:20:42 INFO storage.MemoryStore: Block rdd_2_1 stored as bytes in memory (estimated size 1.0 GB, free 2.5 MB)",
        "17/06/10 15:20:42 INFO storage.MemoryStore: Block rdd_2_2 stored as values in memory (estimated size 12.0 B, free 100.0 B)",
        "17/06/10 15:20:43 INFO storage.MemoryStore: MemoryStore started with capacity 2.0 GB",
        "Block rdd_2_3 stored as bytes in memory (estimated size 1.2.3 KB, free 1.0 KB)",
    )
    blocks = {row.block: (row.kind, row.size_bytes, row.free_bytes) for row in messages.stored_blocks(df).collect()}
    assert blocks == {
        "broadcast_179_piece0": ("broadcast", 5632, 1182925),
        "rdd_2_1": ("rdd", 1024**3, 2621440),
        "rdd_2_2": ("rdd", 12, 100),
        "rdd_2_3": ("rdd", None, 1024),
    }
    assert rows(messages.memory_blocks(df)) == [
        (APP, "broadcast", 1, 5632, 1182925),
        (APP, "rdd", 3, 1024**3 + 12, 100),
    ]
    assert rows(messages.memory_capacity(df)) == [(APP, CONTAINER, 2 * 1024**3)]


def test_input_splits_and_broadcasts(lines):
    df = lines(
        "INFO rdd.HadoopRDD: Input split: hdfs://10.10.34.11:9000/in/a.txt:11902664+1487833",
        "INFO rdd.HadoopRDD: Input split: hdfs://10.10.34.11:9000/in/a.txt:0+7",
        "INFO broadcast.TorrentBroadcast: Started reading broadcast variable 6",
        "INFO broadcast.TorrentBroadcast: Started reading broadcast variable 6",
    )
    assert rows(messages.input_splits(df)) == [("hdfs://10.10.34.11:9000/in/a.txt", 2, 1487840)]
    assert rows(messages.broadcast_reads(df)) == [(APP, 6, 2)]


def test_components(lines):
    df = lines("INFO b: x", "WARN b: y", "INFO a: z", "plain", "plain", "plain")
    assert [tuple(row) for row in messages.components(df).collect()] == [("", 3), ("b", 2), ("a", 1)]
    assert len(messages.components(df, 2).collect()) == 2


def test_error_lines(lines):
    df = lines("17/03/29 10:00:00 INFO a: an ERRORCODE", "17/03/29 10:00:00 ERROR a: x", "fine")
    assert len(messages.error_lines(df).collect()) == 2
    assert rows(messages.error_counts(df)) == [("1485248649253", 2)]


def test_inventory_and_files(lines):
    df = lines(
        ("file:/l/application_1_0001/container_1_0001_01_000001.log", "a"),
        ("file:/l/application_1_0001/container_1_0001_01_000001.log", "b"),
        ("file:/l/application_1_0001/container_1_0001_01_000002.log", "c"),
        ("file:/l/application_1_0002/container_1_0002_01_000001.log", "d"),
        ("file:/l/README", "e"),
    )
    assert rows(messages.inventory(df)) == [(5, 3, 2)]
    files = sources.files_of(df)
    assert rows(messages.file_counts(files)) == [(2, 4)]
    assert [tuple(row) for row in messages.top_apps_by_files(files).collect()] == [
        ("application_1_0001", 2),
        ("application_1_0002", 1),
    ]
    assert {row.container_no: row.role for row in messages.containers(files).collect()} == {
        "000001": "ApplicationMaster",
        "000002": "Executor",
    }
    assert rows(messages.inventory(df.limit(0))) == [(0, 0, 0)]
