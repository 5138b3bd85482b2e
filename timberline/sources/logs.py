"""Log text and the folders it lies in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.functions import parse

# Fixed value: log files lie one level below the folder of their application.
CONTAINER_LOGS = "application_*/*.log"


# In the place of a glob: all files at any depth. Folders are listed in tasks; a glob is matched on the driver, folder by folder.
BELOW = "**"


# Tasks for each core that list folders, at most. Spark's own bound is one for each folder up to 10,000.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 16


def _text(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    if glob != BELOW:
        return spark.read.text(f"{path.rstrip('/')}/{glob}" if glob else path)
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism)))
    try:  # files are listed here, once
        return spark.read.option("recursiveFileLookup", "true").text(path)
    finally:
        spark.conf.set(LISTING, before)


def read_logs(spark: SparkSession, path: str, glob: str | None = CONTAINER_LOGS) -> DataFrame:
    """``file_path, value``, one row per line.

    ``glob`` is put below ``path``; ``"*"`` takes every file of every folder there, ``BELOW`` every file at any depth, ``None``
    takes ``path`` as it is. Small files share a task and large ones are split, as Spark's file settings say.
    """
    return _text(spark, path, glob).select(F.col("_metadata.file_path").alias("file_path"), "value")


# Spark counts a file as so many bytes more than it has, and as no task gets more than a bound of such bytes, tasks of short
# files have few of them. Files up to each of these lengths get tasks of their own, as many as their bytes need.
OPEN_COST = "spark.sql.files.openCostInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"
SHORT = (64 << 10, 512 << 10)
# Tasks for each core that short files are read in, at least, where Spark has as many.
SHORT_TASKS = 4


def read_log_splits(spark: SparkSession, path: str, glob: str | None = CONTAINER_LOGS) -> DataFrame:
    """``file_path, block, value, whole`` as ``read_logs``, with the place in the file where the line's split starts.

    A split is read by one task from start to end, so the lines of a split keep their order up to the next shuffle. ``whole``
    says that the file is known to be one split by its length; a filter on it leaves other files unopened.
    """
    lines = _text(spark, path, glob)
    size = F.col("_metadata.file_size")
    bytes_of = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    cost = bytes_of(spark.conf.get(OPEN_COST))
    # No split is shorter, unless its file is.
    whole = min(cost, bytes_of(spark.conf.get(SPLIT)))

    def of(files: DataFrame, whole: bool) -> DataFrame:
        split = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block")]
        return files.select(*split, "value", F.lit(whole).alias("whole"))

    parts, over = [], -1
    for most in [*[length for length in SHORT if length < whole], *([whole] if whole > 0 else [])]:
        files = lines.filter((size > over) & (size <= most))
        tasks = files.rdd.getNumPartitions()
        if tasks:
            least = min(tasks, SHORT_TASKS * spark.sparkContext.defaultParallelism)
            parts.append(of(files, True).coalesce(max(least, -(-tasks * most // (most + cost)))))
        over = most
    return reduce(DataFrame.unionByName, [*parts, of(lines.filter(size > over), False)])


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``file_path, length, application_id, container_id`` of all files below ``path``.

    Only names and sizes are taken: the plan asks for no content column, so no file is opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(F.col("path").alias("file_path"), "length")
    )
    return files.withColumns(
        {"application_id": parse.owner("file_path"), "container_id": parse.container_id("file_path")}
    )


def files_of(lines: DataFrame) -> DataFrame:
    """The distinct ``file_path`` of a line table, for lines that are no files one could list."""
    return lines.select("file_path").distinct()


def app_catalog(files: DataFrame) -> DataFrame:
    """``cluster_id, application_id, app_number`` of all application folders that hold one of ``files``.

    ``files`` needs only ``file_path``. The id must be the whole name of the folder; other folders are left out.
    """
    return (
        files.select(parse.owner("file_path").alias("application_id"))
        .filter(F.col("application_id") != "")
        .dropDuplicates(["application_id"])
        .select(
            parse.cluster_id("application_id").alias("cluster_id"),
            "application_id",
            parse.app_number("application_id").alias("app_number"),
        )
    )
