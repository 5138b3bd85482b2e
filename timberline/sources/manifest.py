"""Which files a result has been made of, so that another run reads new files only.

A state folder has a folder for each version: the tables of the result and the manifest of the files behind them. A version
counts once its marker is there, which is written last; what a broken run leaves is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = ["file_path", "length", "modified"]
MARKER = "_COMPLETE"
# Paths that are given to one scan.
PATHS_PER_SCAN = 10_000


def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``file_path, length, modified`` of all files below ``path``; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def new_files(files: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files of the listing that the manifest lacks, or knows with another length or time of change."""
    return files if manifest is None else files.join(manifest, FILE, "left_anti")


def chunks(files: DataFrame, size: int = PATHS_PER_SCAN) -> Iterator[list[str]]:
    """Paths of files, a bounded number at a time."""
    held: list[str] = []
    for row in files.select("file_path").toLocalIterator():
        held.append(row.file_path)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def latest(spark: SparkSession, state_dir: str) -> int:
    """Number of the last complete version; 0 if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(state_dir)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return 0
    names = [status.getPath() for status in store.listStatus(root) if status.getPath().getName().startswith("version=")]
    found = [int(path.getName().split("=")[1]) for path in names if store.exists(spark._jvm.org.apache.hadoop.fs.Path(path, MARKER))]
    return max(found, default=0)


def version_path(state_dir: str, version: int) -> str:
    return f"{state_dir.rstrip('/')}/version={version}"


def complete(spark: SparkSession, state_dir: str, version: int) -> None:
    """Mark a version as complete; from now on it is the one that counts."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(version_path(state_dir, version), MARKER)
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()
