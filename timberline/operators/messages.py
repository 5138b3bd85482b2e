"""Figures from the message texts: resources, tasks, Python workers, memory, input and broadcasts.

The owner of a line is the application of its file, so lines which name no application count as well. Each
operator tests for a plain piece of text first and uses its pattern only on the lines left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.functions import parse
from timberline.functions.parse import LEVELS
from timberline.operators import frequent

# Shapes of the messages.
EXECUTOR_REQUEST = r"Will request \d+ executor containers, each with \d+ cores and \d+ MB memory(?: including \d+ MB overhead)?"
CONTAINER_REQUEST = r"<memory:\d+, vCores:\d+>"
TASK = r"(?:Running|Finished) task \d+\.\d+ in stage \d+\.\d+ \(TID \d+\)"
PYTHON_TIMES = r"Times: total = -?\d+, boot = -?\d+, init = -?\d+, finish = -?\d+"
BLOCK_STORED = r"Block \S+ stored as \w+ in memory \(estimated size [\d.]+ (?:B|KB|MB|GB|TB), free [\d.]+ (?:B|KB|MB|GB|TB)\)"
MEMORY_CAPACITY = r"MemoryStore started with capacity ([\d.]+) (B|KB|MB|GB|TB)"
INPUT_SPLIT = r"Input split: (\S+):(\d+)\+(\d+)"
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")
UNIT_STEP = 1024


def _owner() -> Column:
    return parse.owner("file_path").alias("application_id")


def _holding(lines: DataFrame, text: str, pattern: str) -> DataFrame:
    return lines.filter(F.col("value").contains(text) & F.col("value").rlike(pattern))


def _numbers(lines: DataFrame, text: str, pattern: str, names: Sequence[str]) -> DataFrame:
    """Lines holding the pattern, with the numbers in it, in order, as one column each."""
    found = F.regexp_extract(F.col("value"), pattern, 0)
    numbers = _holding(lines, text, pattern).withColumns(
        {"found": found, "numbers": F.regexp_extract_all(found, F.lit(r"-?\d+"), F.lit(0))}
    )
    return numbers.withColumns({name: F.get("numbers", F.lit(i)).try_cast("bigint") for i, name in enumerate(names)})


def _bytes(size: Column, unit: Column) -> Column:
    factor = F.lit(None).cast("bigint")
    for power, name in reversed(list(enumerate(SIZE_UNITS))):
        factor = F.when(unit == name, F.lit(UNIT_STEP**power).cast("bigint")).otherwise(factor)
    return F.round(size.try_cast("double") * factor).try_cast("bigint")


def components(lines: DataFrame, n: int = 20, words: Sequence[str] = LEVELS) -> DataFrame:
    """``component, count`` of the n most frequent components; lines without one count under ``""``."""
    return (
        lines.groupBy(parse.component("value", words).alias("component"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "component")
        .limit(n)
    )


def frequent_components(lines: DataFrame, n: int = 20, words: Sequence[str] = LEVELS) -> DataFrame:
    """``components`` for any number of different ones, as where components are free text; see ``frequent.top``."""
    return frequent.top(lines, parse.component("value", words), "component", n)


def error_lines(lines: DataFrame, word: str = "ERROR") -> DataFrame:
    """The lines that hold the word anywhere."""
    return lines.filter(F.col("value").contains(word)).select("file_path", "value")


def error_counts(lines: DataFrame, word: str = "ERROR") -> DataFrame:
    """``cluster_id, count`` of ``error_lines``; the path is parsed once per file."""
    per_file = error_lines(lines, word).groupBy("file_path").agg(F.count("*").alias("n"))
    return per_file.groupBy(parse.cluster_id("file_path").alias("cluster_id")).agg(F.sum("n").alias("count"))


def resource_requests(lines: DataFrame) -> DataFrame:
    """Executor requests per application: how many, executors asked for, greatest cores, memory, overhead."""
    names = ["executors", "cores", "memory_mb", "overhead_mb"]
    return (
        _numbers(lines, "Will request ", EXECUTOR_REQUEST, names)
        .groupBy(_owner())
        .agg(
            F.count("*").alias("requests"),
            F.sum("executors").alias("executors"),
            F.max("cores").alias("max_cores"),
            F.max("memory_mb").alias("max_memory_mb"),
            F.max("overhead_mb").alias("max_overhead_mb"),
        )
    )


def container_sizes(lines: DataFrame) -> DataFrame:
    """``memory_mb, vcores, count`` of container requests."""
    return (
        _numbers(lines, "<memory:", CONTAINER_REQUEST, ["memory_mb", "vcores"])
        .groupBy("memory_mb", "vcores")
        .agg(F.count("*").alias("count"))
    )


def task_events(lines: DataFrame) -> DataFrame:
    """``application_id, stage, task, attempt, tid, kind, time``, one row per task start or finish."""
    names = ["task", "attempt", "stage", "stage_attempt", "tid"]
    return _numbers(lines, " task ", TASK, names).select(
        _owner(),
        "stage",
        "task",
        "attempt",
        "tid",
        F.substring_index("found", " ", 1).alias("kind"),
        parse.ts("value").alias("time"),
    )


def task_times(events: DataFrame) -> DataFrame:
    """``application_id, tid, start_time, finish_time, seconds`` per task.

    A task id is unique within its application. ``seconds`` is null while one of the ends is unknown.
    """
    times = events.groupBy("application_id", "tid").agg(
        F.min(F.when(F.col("kind") == "Running", F.col("time"))).alias("start_time"),
        F.max(F.when(F.col("kind") == "Finished", F.col("time"))).alias("finish_time"),
    )
    seconds = (F.col("finish_time") - F.col("start_time")).cast("interval second").cast("bigint")
    return times.withColumn("seconds", seconds)


def task_time_by_app(times: DataFrame) -> DataFrame:
    """Tasks per application and their mean time; tasks without a time and those that end before they
    start are left out of the mean and counted apart."""
    seconds = F.col("seconds")
    return times.groupBy("application_id").agg(
        F.count("*").alias("tasks"),
        F.count_if(seconds.isNull()).alias("untimed"),
        F.count_if(seconds < 0).alias("negative"),
        F.avg(F.when(seconds >= 0, seconds)).alias("mean_seconds"),
    )


def stage_spread(events: DataFrame) -> DataFrame:
    """``application_id, stage, tasks, min_seconds, mean_seconds, max_seconds, skew`` over tasks with a known time.

    ``skew`` is the longest time over the mean; null where all times are 0. A task counts in each stage that names it.
    """
    ends = {"start_time": F.min(F.when(F.col("kind") == "Running", F.col("time"))), "finish_time": F.max(F.when(F.col("kind") == "Finished", F.col("time")))}
    times = events.groupBy("application_id", "stage", "tid").agg(*[end.alias(name) for name, end in ends.items()])
    seconds = (F.col("finish_time") - F.col("start_time")).cast("interval second").cast("bigint")
    known = times.withColumn("seconds", seconds).groupBy("application_id", "stage").agg(
        F.count_if(F.col("seconds") >= 0).alias("tasks"),
        *[how(F.when(F.col("seconds") >= 0, F.col("seconds"))).alias(f"{name}_seconds") for name, how in (("min", F.min), ("mean", F.avg), ("max", F.max))],
    )
    skew = F.when(F.col("mean_seconds") > 0, F.col("max_seconds") / F.col("mean_seconds"))
    return known.filter("tasks > 0").withColumn("skew", skew)


def python_times(lines: DataFrame) -> DataFrame:
    """``application_id, container_id, total, boot, init, finish`` in milliseconds, as logged."""
    names = ["total", "boot", "init", "finish"]
    return _numbers(lines, "Times: total = ", PYTHON_TIMES, names).select(
        _owner(), parse.container_id("file_path").alias("container_id"), *names
    )


def first_python_times(times: DataFrame, n: int = 20) -> DataFrame:
    """n rows of ``python_times`` in the order of their columns."""
    return times.orderBy(*times.columns).limit(n)


def stored_blocks(lines: DataFrame) -> DataFrame:
    """``application_id, block, kind, size_bytes, free_bytes``, one row per stored block."""
    found = F.regexp_extract("value", BLOCK_STORED, 0)
    blocks = _holding(lines, "stored as ", BLOCK_STORED).withColumn("part", F.split(found, " "))

    def part(i: int) -> Column:
        return F.translate(F.get("part", F.lit(i)), ",)", "")

    # Block <name> stored as <form> in memory (estimated size <n> <unit>, free <n> <unit>)
    name = F.get("part", F.lit(1))
    return blocks.select(
        _owner(),
        name.alias("block"),
        F.substring_index(name, "_", 1).alias("kind"),
        _bytes(part(9), part(10)).alias("size_bytes"),
        _bytes(part(12), part(13)).alias("free_bytes"),
    )


def memory_blocks(lines: DataFrame) -> DataFrame:
    """``application_id, kind, blocks, size_bytes, min_free_bytes`` per application and kind of block."""
    return (
        stored_blocks(lines)
        .groupBy("application_id", "kind")
        .agg(
            F.count("*").alias("blocks"),
            F.sum("size_bytes").alias("size_bytes"),
            F.min("free_bytes").alias("min_free_bytes"),
        )
    )


def memory_capacity(lines: DataFrame) -> DataFrame:
    """``application_id, container_id, capacity_bytes`` where a memory store reports its capacity."""
    size, unit = (F.regexp_extract("value", MEMORY_CAPACITY, i) for i in (1, 2))
    return _holding(lines, "MemoryStore started", MEMORY_CAPACITY).select(
        _owner(), parse.container_id("file_path").alias("container_id"), _bytes(size, unit).alias("capacity_bytes")
    )


def split_reads(lines: DataFrame) -> DataFrame:
    """``path, offset, length``, one row per split that was read."""
    path, offset, length = (F.regexp_extract("value", INPUT_SPLIT, i) for i in (1, 2, 3))
    return _holding(lines, "Input split: ", INPUT_SPLIT).select(
        path.alias("path"), offset.try_cast("bigint").alias("offset"), length.try_cast("bigint").alias("length")
    )


def input_splits(lines: DataFrame) -> DataFrame:
    """``path, splits, bytes`` read per input file; a split that is read again counts again (see ``sweep.coverage``)."""
    return split_reads(lines).groupBy("path").agg(F.count("*").alias("splits"), F.sum("length").alias("bytes"))


def broadcast_reads(lines: DataFrame) -> DataFrame:
    """``application_id, broadcast_id, reads``: reads of broadcast variables that were started."""
    number = F.regexp_extract("value", BROADCAST_READ, 1).try_cast("bigint")
    return (
        _holding(lines, "Started reading broadcast", BROADCAST_READ)
        .groupBy(_owner(), number.alias("broadcast_id"))
        .agg(F.count("*").alias("reads"))
    )


def inventory(lines: DataFrame) -> DataFrame:
    """One row: ``lines, containers, applications``; lines are counted per file before ids are parsed."""
    return (
        lines.groupBy("file_path")
        .agg(F.count("*").alias("n"))
        .select("n", parse.container_id("file_path").alias("container_id"), _owner())
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
            F.count_distinct(F.nullif("container_id", F.lit(""))).alias("containers"),
            F.count_distinct(F.nullif("application_id", F.lit(""))).alias("applications"),
        )
    )


def containers(files: DataFrame) -> DataFrame:
    """Parts of the container names of ``files``: ids, attempt, number, role and start of the cluster."""
    names = files.select(parse.container_id("file_path").alias("container_id")).filter(F.col("container_id") != "")
    return names.distinct().select(
        "container_id",
        parse.container_part("container_id", 1).alias("cluster_id"),
        parse.container_part("container_id", 2).alias("app_number"),
        parse.container_part("container_id", 3).alias("attempt"),
        parse.container_part("container_id", 4).alias("container_no"),
        parse.container_role("container_id").alias("role"),
        parse.cluster_start(parse.container_part("container_id", 1)).alias("cluster_start"),
    )


def file_counts(files: DataFrame) -> DataFrame:
    """One row: ``applications, files``, over a table with one row per file."""
    return files.agg(
        F.count_distinct(F.nullif(parse.owner("file_path"), F.lit(""))).alias("applications"),
        F.count("*").alias("files"),
    )


def top_apps_by_files(files: DataFrame, n: int = 5) -> DataFrame:
    """``application_id, files`` of the n applications with most files; ties by id."""
    return (
        files.groupBy(_owner())
        .agg(F.count("*").alias("files"))
        .filter(F.col("application_id") != "")
        .orderBy(F.desc("files"), "application_id")
        .limit(n)
    )


def app_bytes(files: DataFrame) -> DataFrame:
    """``application_id, containers, bytes`` over a file inventory."""
    return (
        files.filter(F.col("application_id") != "")
        .groupBy("application_id")
        .agg(
            F.count_distinct(F.nullif("container_id", F.lit(""))).alias("containers"),
            F.sum("length").alias("bytes"),
        )
    )


def app_size_stats(sizes: DataFrame) -> DataFrame:
    """One row over ``app_bytes``: least, greatest and mean bytes, mean containers."""
    return sizes.agg(
        F.count("*").alias("applications"),
        F.sum("containers").alias("containers"),
        F.sum("bytes").alias("bytes"),
        F.min("bytes").alias("min_bytes"),
        F.max("bytes").alias("max_bytes"),
        F.avg("bytes").alias("avg_bytes"),
        F.avg("containers").alias("avg_containers"),
    )
