"""Column expressions over a log line (``value``) or a file path (``file_path``).

Each one takes a column or its name and returns a column. Text that does not match gives ``""`` for text
results and null for numbers and times; nothing here raises on bad lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words and shapes of the log format.
LEVELS = ("INFO", "WARN", "ERROR", "DEBUG")
APPLICATION_ID = r"application_\d+_\d+"
APPLICATION_PARTS = r"application_(\d+)_(\d+)"
CONTAINER_ID = r"container_\d+_\d+_\d+_\d+"
CONTAINER_PARTS = r"container_(\d+)_(\d+)_(\d+)_(\d+)"
MASTER_CONTAINER = 1
SHORT_TIME = r"\d{2}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}"
LONG_TIME = r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}"
HEADER_TIME = rf"^(?:{SHORT_TIME}|{LONG_TIME})"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(words: Sequence[str]) -> str:
    return "|".join(words)


def _text(c: Column) -> Column:
    # Never null, so that joins and filters on the result put no second null test on the raw line.
    return F.coalesce(c, F.lit(""))


def level(
    line: Column | str = "value",
    words: Sequence[str] = LEVELS,
    bounded: bool = True,
    header_only: bool = False,
) -> Column:
    """First level word of the line.

    ``bounded`` asks for whole words (``INFORMATION`` holds none); ``header_only`` takes only the word
    right after the leading time, not one from the message.
    """
    if header_only:
        pattern = rf"{HEADER_TIME}\s+({_words(words)})\b"
    elif bounded:
        pattern = rf"\b({_words(words)})\b"
    else:
        pattern = f"({_words(words)})"
    return _text(F.regexp_extract(_col(line), pattern, 1))


def level_words(line: Column | str = "value", words: Sequence[str] = LEVELS) -> Column:
    """All level words of the line in their order, as an array, without word boundaries."""
    return F.regexp_extract_all(_col(line), F.lit(f"({_words(words)})"), F.lit(1))


def component(line: Column | str = "value", words: Sequence[str] = LEVELS) -> Column:
    """Text between the level and the next colon."""
    return _text(F.regexp_extract(_col(line), rf"\b({_words(words)})\s+([^:]+):", 2))


def app_id(c: Column | str) -> Column:
    """First application id named in a line or a path, such as ``application_1485248649253_0052``."""
    return _text(F.regexp_extract(_col(c), APPLICATION_ID, 0))


def owner(path: Column | str = "file_path") -> Column:
    """Application whose folder a file lies in: the last folder on the path with such a name, or ``name=`` and it.

    The id has to be the whole name, so ``old_application_1_2`` owns nothing, nor does a folder further up.
    """
    return _text(F.regexp_extract(_col(path), rf"^(?:.*/)?(?:\w+=)?({APPLICATION_ID})/", 1))


def cluster_id(c: Column | str) -> Column:
    """Cluster part of the first application id."""
    return _text(F.regexp_extract(_col(c), APPLICATION_PARTS, 1))


def app_number(c: Column | str) -> Column:
    """Number part of the first application id, zeros kept."""
    return _text(F.regexp_extract(_col(c), APPLICATION_PARTS, 2))


def ts_text(line: Column | str = "value") -> Column:
    """Leading time of a line as it is written."""
    return _text(F.regexp_extract(_col(line), HEADER_TIME, 0))


def parse_ts(text: Column | str) -> Column:
    """Time of ``yy/MM/dd HH:mm:ss`` or ``yyyy-MM-dd HH:mm:ss`` text; null for anything else.

    Both shapes become ISO text for a tolerant cast. Unlike a pattern parser it needs no session zone and
    raises no exception inside for each text of the other shape.
    """
    t = _col(text)
    return F.when(_is_short(t), _iso(t)).otherwise(t).try_cast("timestamp_ntz")


def _is_short(c: Column) -> Column:
    return c.substr(3, 1) == "/"


def _iso(short: Column) -> Column:
    return F.concat(F.lit("20"), F.translate(short, "/", "-"))


def ts(line: Column | str = "value") -> Column:
    """Leading time of a line: ``parse_ts(ts_text(line))``, but with one pattern tried per line."""
    c = _col(line)
    short = F.regexp_extract(c, f"^{SHORT_TIME}", 0)
    long = F.regexp_extract(c, f"^{LONG_TIME}", 0)
    return F.when(_is_short(c), _iso(short)).otherwise(long).try_cast("timestamp_ntz")


def container_id(path: Column | str = "file_path") -> Column:
    return _text(F.regexp_extract(_col(path), CONTAINER_ID, 0))


def container_part(path: Column | str, part: int) -> Column:
    """Part of a container name: 1 cluster, 2 application number, 3 attempt, 4 container number."""
    return _text(F.regexp_extract(_col(path), CONTAINER_PARTS, part))


def container_role(path: Column | str = "file_path") -> Column:
    """The first container runs the application master, the others run executors."""
    number = container_part(path, 4).try_cast("bigint")
    return F.when(number == MASTER_CONTAINER, "ApplicationMaster").when(number.isNotNull(), "Executor")


def cluster_start(cluster: Column | str = "cluster_id") -> Column:
    """Start time of a cluster: its id is in milliseconds since 1970."""
    seconds = (_col(cluster).try_cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def with_header(lines: DataFrame) -> DataFrame:
    """Every line with its leading time, level and component; ``message`` is the whole line."""
    return lines.select(
        "file_path",
        ts_text("value").alias("ts_text"),
        level("value").alias("level"),
        component("value").alias("component"),
        F.col("value").alias("message"),
    )
