"""Log lines and trips derived from the given tables, row for row.

``TYPED`` keeps the parts of each line as typed columns; the line text is put together from them, and the
operators have to parse it again. It is plain SQL, so a check can start from the same typed columns.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.functions import parse
from timberline.operators.daily import TLC
from timberline.operators.small import made_small
from timberline.session import local_folder, materialize, scratch_path, scratch_root
from timberline.sources import BELOW

TYPED = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type,
    CASE user_id % 3 WHEN 0 THEN '1440487435730' WHEN 1 THEN '1472621869829' ELSE '1485248649253' END AS cluster_id,
    lpad(CAST(user_id AS STRING), 4, '0') AS app_number,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'INFO' WHEN 'click' THEN 'INFO' END AS lvl,
    CASE event_type WHEN 'error' THEN 'rdd.HadoopRDD' WHEN 'signup' THEN 'YarnAllocator'
                    WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'broadcast.TorrentBroadcast' ELSE 'storage.MemoryStore' END
                    WHEN 'click' THEN CASE WHEN event_id % 3 = 2 THEN 'python.PythonRunner' ELSE 'executor.Executor' END END AS comp,
    event_id % 10 AS tid,
    event_id % 5 <> 0 AND user_id % 50 <> 7 AS says_app
  FROM {events}
), m AS (
  SELECT *,
    concat('application_', cluster_id, '_', app_number) AS application_id,
    concat('container_', cluster_id, '_', app_number, '_01_', lpad(CAST(1 + event_id % 4 AS STRING), 6, '0')) AS container_id,
    CASE WHEN event_id % 2 = 0 THEN replace(substr(CAST(ts AS STRING), 3, 17), '-', '/') ELSE substr(CAST(ts AS STRING), 1, 19) END AS ts_text,
    CASE event_type
      WHEN 'error' THEN concat('Input split: hdfs://10.0.0.1:9000/in/part', CAST(event_id % 4 AS STRING), '.txt:', CAST(event_id * 100 AS STRING), '+', CAST(user_id * 7 AS STRING), CASE WHEN event_id % 7 = 0 THEN ' after WARN' ELSE '' END)
      WHEN 'signup' THEN CASE WHEN event_id % 3 = 0
        THEN concat('Container request (host: Any, capability: <memory:', CAST(1024 * (1 + user_id % 4) AS STRING), ', vCores:', CAST(1 + user_id % 5 AS STRING), '>)')
        ELSE concat('Will request ', CAST(1 + user_id % 16 AS STRING), ' executor containers, each with ', CAST(1 + user_id % 5 AS STRING), ' cores and ', CAST(1024 * (1 + user_id % 4) AS STRING), ' MB memory', CASE WHEN event_id % 2 = 0 THEN concat(' including ', CAST(384 + user_id AS STRING), ' MB overhead') ELSE '' END) END
      WHEN 'purchase' THEN CASE WHEN event_id % 13 = 5
        THEN concat('MemoryStore started with capacity ', CAST(1 + user_id % 900 AS STRING), '.5 MB')
        WHEN event_id % 3 = 0
        THEN concat('Started reading broadcast variable ', CAST(event_id % 20 AS STRING))
        ELSE concat('Block broadcast_', CAST(event_id AS STRING), ' stored as bytes in memory (estimated size ', CAST(1 + event_id % 900 AS STRING), '.5 ', CASE WHEN event_id % 4 = 0 THEN 'MB' ELSE 'KB' END, ', free 1155.2 KB)') END
      WHEN 'click' THEN CASE event_id % 3
        WHEN 0 THEN concat('Running task ', CAST(tid AS STRING), '.0 in stage ', CAST(tid % 3 AS STRING), '.0 (TID ', CAST(tid AS STRING), ')')
        WHEN 1 THEN concat('Finished task ', CAST(tid AS STRING), '.0 in stage ', CAST(tid % 3 AS STRING), '.0 (TID ', CAST(tid AS STRING), '). 2076 bytes result sent to driver')
        ELSE concat('Times: total = ', CAST(event_id AS STRING), ', boot = ', CAST(user_id - 75 AS STRING), ', init = ', CAST(event_id - user_id + 75 - 3 AS STRING), ', finish = 3') END
    END AS body
  FROM e
), l AS (
  SELECT *,
    concat('file:/logs/', application_id, '/', container_id, '.log') AS file_path,
    CASE WHEN event_type = 'view'
      THEN concat('    INFORMATION frame ', CAST(event_id AS STRING), CASE WHEN says_app THEN concat(' of ', application_id) ELSE '' END)
      ELSE concat(ts_text, ' ', lvl, ' ', comp, ': ', body, CASE WHEN says_app THEN concat(' for ', application_id) ELSE '' END) END AS value
  FROM m
)
"""


# Lines with what may follow a line with an error: the text of an exception and its frames, in lines of their own.
TRACED = TYPED + """, t AS (
  SELECT *, concat(value,
    CASE WHEN lvl = 'ERROR' AND event_id % 4 > 0 THEN concat(chr(10), 'java.io.IOException: INFO of ', CAST(event_id AS STRING)) ELSE '' END,
    CASE WHEN lvl = 'ERROR' AND event_id % 4 > 1 THEN concat(chr(10), chr(9), 'at x.Reader.read(', CAST(user_id AS STRING), ')') ELSE '' END,
    CASE WHEN lvl = 'ERROR' AND event_id % 4 > 2 THEN concat(chr(10), chr(9), '... ', CAST(event_id % 9 AS STRING), ' more') ELSE '' END) AS entry
  FROM l
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, file_path, value``: one log line per event."""
    return spark.sql(TYPED + "SELECT event_id, file_path, value FROM l", events=table(spark, sf_dir, "events"))


def log_folder(spark: SparkSession, sf_dir: str, by: tuple[str, ...] = ("app", "container")) -> str:
    """The same lines as text files, in a folder per application and container; returns the root folder.

    A folder with very many lines is split over several tasks and gets several files. The folder is written once in a session.
    """
    return _once(spark, sf_dir, ("logs", *by), lambda path: _write_logs(spark, sf_dir, by, path))


# Folders by session, tables and content.
_folders: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, what: tuple[str, ...], write: Callable[[str], None]) -> str:
    root = scratch_root(spark)
    if (root, sf_dir, what) not in _folders:
        path = scratch_path(spark, what[0])
        write(path)
        _folders[root, sf_dir, what] = path
    return _folders[root, sf_dir, what]


# Folders and lines of a task that writes text files, about. Opening a file takes longer than writing the few lines of it, so
# the number of tasks has to follow the folders as well as the lines.
TASK_FOLDERS, TASK_LINES = 250, 200_000


def _sizes(rows: DataFrame, by: tuple[str, ...]) -> tuple[DataFrame, int]:
    """``by, lines`` of each folder, and the number of tasks that write them."""
    sizes = materialize(rows.groupBy(*by).agg(F.count("*").alias("lines")), "folder-sizes")
    folders, lines = sizes.agg(F.count("*"), F.coalesce(F.sum("lines"), F.lit(0))).first()
    return sizes, max(1, -(-folders // TASK_FOLDERS), -(-lines // TASK_LINES))


def _write_logs(spark: SparkSession, sf_dir: str, by: tuple[str, ...], path: str) -> None:
    rows = logs(spark, sf_dir).select(
        "event_id",
        parse.owner("file_path").alias("app"),
        F.concat(parse.container_id("file_path"), F.lit(".log")).alias("container"),
        "value",
    )
    sizes, tasks = _sizes(rows, by)
    # Only folders with more lines than a task should have, of which there are fewer than tasks.
    large = sizes.where(F.col("lines") > TASK_LINES)
    large = large.select(*[F.col(name).alias(f"_{name}") for name in by], F.ceil(F.col("lines") / TASK_LINES).alias("_slices"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in by]
    dealt = rows.join(made_small(large, tasks), same, "left")
    dealt = dealt.withColumn("_slice", F.pmod(F.xxhash64("event_id"), F.coalesce("_slices", F.lit(1))))
    dealt.repartition(tasks, *by, "_slice").select("value", *by).write.partitionBy(*by).text(path)


def _write_local(rows: DataFrame, by: str, root: str) -> int:
    """``rows.write.partitionBy(by).text(root)`` in the store of local files, for rows that are sorted by ``by``; returns their number.

    Same folders, names of files and bytes. Hadoop's local store starts a ``chmod`` four times for a file and its checksum,
    which takes far longer than the few lines of it, so the tasks open these files on their own. A file gets its name when it
    is complete, and a task that runs again puts the same file in its place. ``by`` must need no escape in a name of a folder.
    """
    job = uuid.uuid4()
    folder = F.concat(F.lit(f"{by}="), F.coalesce(by, F.lit("__HIVE_DEFAULT_PARTITION__")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}-{job}.c000.txt"
        own = f".{name}.{uuid.uuid4().hex}"
        count, last, out = 0, None, None
        for batch in batches:
            values, start = batch.column("value").cast(pa.binary()).to_pylist(), 0
            for place, group in groupby(batch.column("folder").to_pylist()):
                if place != last:
                    if out:
                        out.close()
                        os.replace(f"{root}/{last}/{own}", f"{root}/{last}/{name}")
                    os.makedirs(f"{root}/{place}", exist_ok=True)
                    last, out = place, open(f"{root}/{place}/{own}", "wb")
                stop = start + len(list(group))
                out.write(b"\n".join(values[start:stop]) + b"\n")
                start = stop
            count += batch.num_rows
        if out:
            out.close()
            os.replace(f"{root}/{last}/{own}", f"{root}/{last}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["lines"])

    written = rows.select(folder.alias("folder"), F.coalesce("value", F.lit("")).alias("value")).mapInArrow(run, "lines long")
    return written.agg(F.sum("lines")).first()[0] or 0


def trace_folder(spark: SparkSession, sf_dir: str) -> str:
    """The lines with traces as text files, one for each container, in the order of the events; returns the root folder."""

    def write(path: str) -> None:
        rows = spark.sql(TRACED + "SELECT event_id, entry AS value, container_id AS container FROM t", events=table(spark, sf_dir, "events"))
        sizes, tasks = _sizes(rows, ("container",))
        ordered = rows.repartition(tasks, "container").sortWithinPartitions("container", "event_id").select("value", "container")
        root = local_folder(spark, path)
        if root is None:
            ordered.write.partitionBy("container").text(path)
        else:
            os.makedirs(root)
            wanted = sizes.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
            if (got := _write_local(ordered, "container", root)) != wanted:
                raise RuntimeError(f"{got} of {wanted} entries were written to {root}")

    return _once(spark, sf_dir, ("traces",), write)


# Places of the log files in the folders above: by container, and by application alone.
TRACE_LOGS = BELOW
FOLDER_LOGS = "app=application_*/*"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias(TLC.pickup),
        F.col("l_quantity").alias(TLC.distance),
        F.col("l_tax").alias(TLC.tax),
        F.col("l_extendedprice").alias(TLC.fare),
        F.col("l_discount").alias(TLC.tip),
        F.col("l_linenumber").alias(TLC.passengers),
    )


# Place of a month in the folder below.
FOLDER_MONTH = "yyyy={year}/mm={month}"


def trip_folder(spark: SparkSession, sf_dir: str) -> str:
    """The trips as Parquet in a folder per year and month, written once in a session; returns the root folder."""
    months = trips(spark, sf_dir).withColumns({"yyyy": F.year(TLC.pickup), "mm": F.month(TLC.pickup)})
    by_month = months.hint("rebalance", "yyyy", "mm").write.partitionBy("yyyy", "mm")
    return _once(spark, sf_dir, ("trips",), by_month.parquet)
