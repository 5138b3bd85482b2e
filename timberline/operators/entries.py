"""Entries of several lines: a header line and the lines without a header that follow it, such as stack traces.

Files are read in splits, each from its start to its end by one task. Inside of a split the last header is carried along;
what a split cannot know is the header that was open at its start. So a first pass leaves one row for each split: its
number of lines and its last header. Carried over the splits of a file in their order, these rows tell
each split what was open, whatever the splits are. Files that are one split have no need of it and are read once. Lines are never
shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timberline.functions import parse
from timberline.operators.small import with_small
from timberline.session import materialize

HEADER = ["ts_text", "level", "component"]
# Splits of all files that are sent to every task. Beyond that, lines that need them are joined apart.
MOST_SPLITS = 200_000

_KEYS = "file_path string, block long"
_HEADER = "ts_text string, level string, component string"


def headed(lines: DataFrame) -> DataFrame:
    """``file_path, block, value`` and the parts of the header, null on lines that have none: those without a leading time."""
    ts_text = parse.ts_text("value")
    parts = {"ts_text": ts_text, "level": parse.level("value"), "component": parse.component("value")}
    return lines.select("file_path", "block", "value", *[F.when(ts_text != "", part).alias(name) for name, part in parts.items()])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray]]:
    """Rows of one split each, with the number of rows of the split before them: ``rows, first row, header rows``.

    A task reads its splits one after the other; a split may go over several batches.
    """
    split, at = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column("file_path").dictionary_encode(), batch.column("block").to_numpy(zero_copy_only=False)
        codes = path.indices.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1
        for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            own = (path.dictionary[int(codes[start])].as_py(), int(block[start]))
            if own != split:
                split, at = own, 0
            rows = batch.slice(start, stop - start)
            yield rows, at, np.flatnonzero(rows.column("ts_text").is_valid().to_numpy(zero_copy_only=False))
            at += stop - start


def splits(lines: DataFrame) -> DataFrame:
    """``file_path, block, lines, last_header`` and the parts of the last header; a row for each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file_path", "block", "lines", "last_header", *HEADER]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        fact = None
        for rows, at, headers in _runs(batches):
            if at == 0:
                if fact:
                    yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(fact, kinds)], names=names)
                fact = [rows.column("file_path")[0].as_py(), rows.column("block")[0].as_py(), 0, None, None, None, None]
            fact[2] += rows.num_rows
            if headers.size:
                last = int(headers[-1])
                fact[3:] = [at + last, *[rows.column(name)[last].as_py() for name in HEADER]]
        if fact:
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(fact, kinds)], names=names)

    return headed(lines).drop("value").mapInArrow(run, f"{_KEYS}, lines long, last_header long, {_HEADER}")


def open_headers(facts: DataFrame) -> DataFrame:
    """``file_path, block, open_lines`` and the header that is open at the start of a split, from the second one of a file on.

    ``open_lines`` have passed since that header; where no header came before, its parts are null and all lines of the file
    have passed. The window has a row for each split of a file.
    """
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = facts.withColumn("first_line", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    header = F.struct((F.col("first_line") + F.col("last_header")).alias("at"), *HEADER)
    found = found.withColumn("header", F.when(F.col("last_header").isNotNull(), header))
    found = found.withColumn("open", F.last("header", ignorenulls=True).over(before)).filter("first_line > 0")
    passed = F.col("first_line") - F.coalesce("open.at", F.lit(0))
    return found.select("file_path", "block", passed.alias("open_lines"), *[F.col(f"open.{name}").alias(f"open_{name}") for name in HEADER])


def carried(lines: DataFrame) -> DataFrame:
    """``file_path, block, value, line_no`` and the header of the line's entry, as far as its split knows it.

    ``line_no`` is 0 for the header itself. Lines before a split's first header have no header yet and count from the
    split's start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Header that was open at the end of the batch before, and where it was.
        open_at, open_header = None, pa.nulls(0)
        for rows, at, headers in _runs(batches):
            if at == 0:
                open_at = None
            # Rows of the header table that each line belongs to: -1 is the one carried along.
            place = np.zeros(rows.num_rows, np.int64)
            place[headers] = 1
            place = np.cumsum(place) - 1
            number = np.arange(at, at + rows.num_rows)
            starts = np.concatenate([[0 if open_at is None else open_at], headers + at])
            own = []
            for name in HEADER:
                column = rows.column(name).take(pa.array(headers))
                first = pa.array([None if open_at is None else open_header[name]], pa.string())
                own.append(pa.concat_arrays([first, column.cast(pa.string())]).take(pa.array(place + 1)))
            yield pa.RecordBatch.from_arrays(
                [rows.column("file_path"), rows.column("block"), rows.column("value"), pa.array(number - starts[place + 1]), *own],
                names=["file_path", "block", "value", "line_no", *HEADER],
            )
            if headers.size:
                last = int(headers[-1])
                open_at, open_header = at + last, {name: rows.column(name)[last].as_py() for name in HEADER}

    return headed(lines).mapInArrow(run, f"{_KEYS}, value string, line_no long, {_HEADER}")


def entries(lines: DataFrame, most_splits: int = MOST_SPLITS) -> DataFrame:
    """``file_path, block, line_no, ts_text, level, component, value``: every line, with the header of its entry.

    ``lines`` is a table of ``sources.read_log_splits``. A header is a line with a leading time. ``line_no`` counts the lines of
    an entry from 0, the header. Lines before the first header of a file have null parts and count from the file's start. The
    result is the same for any size of splits but for ``block``.
    """
    if "whole" not in lines.columns:
        lines = lines.withColumn("whole", F.lit(False))
    whole, parts = lines.filter("whole"), lines.filter("NOT whole")
    # Only if the settings of splits were changed since the lines were read.
    later = F.raise_error(F.concat(F.lit("a file that was to be one split has several: "), "file_path"))
    whole = whole.withColumn("block", F.when(F.col("block") == 0, F.col("block")).otherwise(later.cast("long")))
    opened = materialize(open_headers(materialize(splits(parts), "splits")), "open-headers")
    keys, orphan = ["file_path", "block"], F.col("ts_text").isNull()

    def filled(found: DataFrame) -> DataFrame:
        parts = [F.coalesce(name, f"open_{name}").alias(name) for name in HEADER]
        number = F.col("line_no") + F.when(orphan, F.coalesce("open_lines", F.lit(0))).otherwise(0)
        return found.select(*keys, number.alias("line_no"), *parts, "value")

    found = with_small(carried(parts), opened, keys, most_splits, filled, orphan)
    return found.unionByName(carried(whole).select(found.columns))


def entry_sizes(found: DataFrame) -> DataFrame:
    """``level, component, entries, lines, most_lines, bytes`` over ``entries``: how long entries are, by level and component."""
    header = F.col("line_no") == 0
    return found.filter("ts_text is not null").groupBy("level", "component").agg(
        F.count_if(header).alias("entries"),
        F.count("*").alias("lines"),
        (F.max("line_no") + 1).alias("most_lines"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )
