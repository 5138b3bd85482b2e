"""Session settings and the shared folder for results which several jobs read."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold for a laptop and for a cluster alike. Shuffle partitions are not fixed: adaptive
# execution merges small ones and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.driver.maxResultSize": "2g",
    # The JVM leaves larger methods uncompiled; Spark then splits a wide expression instead of fusing it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Percentile sketches are hashed up to so many groups in a task and sorted beyond: just above the days of a year.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "400",
}

# Folder below the warehouse that takes the place of spark.checkpoint.dir where that is not set.
SCRATCH_FOLDER = "scratch"

# Deletes the shuffle files of a statement when it is done.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Roots made by this process, by application: one folder for each session.
_roots: dict[str, str] = {}


def settings(
    shuffle_partitions: int | None = None,
    listing_tasks: int | None = None,
    max_scan_tasks: int | None = None,
    s3_credentials: str | None = None,
    **extra: str,
) -> dict[str, str]:
    """Settings of a session, by name.

    ``shuffle_partitions`` is the starting point of adaptive execution; give about two to three times the
    cluster's cores for large inputs. ``listing_tasks`` bounds the tasks that list folders; Spark's own
    bound, one folder per task up to 10,000, suits a large cluster. ``max_scan_tasks`` is the number of tasks that a
    scan should have at most; it matters for listings of very many bytes, as tasks follow the length of files even
    where only their names are read. ``s3_credentials`` is the class name of
    a credentials provider and turns on the S3A file system. Further settings are given in ``extra`` with
    ``__`` for each dot, for example ``spark__executor__memory="16g"``, and win over those above.
    """
    chosen = dict(SETTINGS)
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if listing_tasks:
        chosen["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(listing_tasks)
    if max_scan_tasks:
        chosen["spark.sql.files.maxPartitionNum"] = str(max_scan_tasks)
    if s3_credentials:
        chosen["spark.hadoop.fs.s3a.impl"] = "org.apache.hadoop.fs.s3a.S3AFileSystem"
        chosen["spark.hadoop.fs.s3a.aws.credentials.provider"] = s3_credentials
    chosen.update({key.replace("__", "."): value for key, value in extra.items()})
    return chosen


def session(app_name: str = "timberline", master: str | None = None, **chosen) -> SparkSession:
    """Build the session; ``chosen`` is passed on to ``settings``. Without ``master``, as submitted."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings(**chosen).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The session's own folder in ``spark.checkpoint.dir``, or where that is unset in the warehouse.

    The rule is the same for every master. Both folders are shared by the driver and all executors.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{SCRATCH_FOLDER}"
        _roots[app] = f"{shared.rstrip('/')}/session-{app}-{uuid.uuid4().hex}"
        atexit.register(clean_scratch, spark)
    return _roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def local_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system knows it, if it lies in the store of local files; those of all executors are one, as said above."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(target).toUri().getPath() if store.getUri().getScheme() == "file" else None


def clean_scratch(spark: SparkSession) -> None:
    """Delete what the session has written to its shared folder; also called when the process ends.

    A session that was stopped before can no longer reach the file system, so call this before ``stop``.
    """
    if spark.sparkContext._jsc is None:
        return
    root = _roots.pop(spark.sparkContext.applicationId, None)
    if root:
        delete_path(spark, root)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several jobs need and read it back.

    The scan behind it runs once, a lost executor costs no second scan, and later joins are planned with
    the size of the written files instead of an estimate. The shuffle files of the job are deleted at its
    end, as the table takes their place.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """A folder for tables that are needed until a result is written: ``with Workspace(spark, name) as kept``.

    ``kept(df, name)`` writes a table there, as ``materialize`` does, and reads it back; the folder is deleted at
    the end, also after an error.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.number = spark, scratch_path(spark, name), 0

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        delete_path(self.spark, self.folder)

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        self.number += 1
        return _written(df, f"{self.folder}/{self.number}-{name}")
