"""Sinks: CSV tables and text reports. Spark writes folders; the caller names them.

An earlier result is replaced, unless ``mode`` says otherwise (``"error"``, ``"ignore"``, as Spark's writers have it).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from timberline.functions.text import times_as_text


def refuse_existing(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise if one of the paths is there already; asked before a job reads anything."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            raise FileExistsError(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; missing values and times are empty fields, quotes are doubled, blanks are kept.

    The number of files follows the data: adaptive execution leaves a small result in one partition, and
    so in one file, while a large one is written in parallel.
    """
    (
        times_as_text(df)
        .write.option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, mode=mode)
    )


def write_lines(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text file of a report (``ord, line``). A report has a fixed number of lines, so one file is enough."""
    report.repartition(1).sortWithinPartitions("ord").select("line").write.mode(mode).text(path)
