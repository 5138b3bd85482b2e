"""Level distribution of log lines: totals, counts, shares, report and samples.

All figures come from one grouped count (``groups``), so the text is read once for any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timberline.functions import parse
from timberline.functions.text import LEVEL_HEADS, LEVEL_LINE, count_text
from timberline.functions.parse import LEVELS
from timberline.operators.running import sums_before
from timberline.operators.small import made_small
from timberline.session import materialize


def groups(lines: DataFrame, words: Sequence[str] = LEVELS, header_only: bool = False) -> DataFrame:
    """``log_level, count`` over all lines, those without a level under ``""``."""
    found = parse.level("value", words, header_only=header_only)
    return lines.groupBy(found.alias("log_level")).agg(F.count("*").alias("count"))


def _named(key: str, count: str) -> Column:
    # A test of the key alone would be moved below the grouping, and the pattern would run twice per line.
    return F.when(F.col(key) != "", F.col(count)) > 0


def level_domain(df: DataFrame, words: Sequence[str] = LEVELS) -> DataFrame:
    """``ord, log_level``: the level words in their order, in one partition that Spark knows to be sorted."""
    domain = df.sparkSession.range(0, len(words), 1, numPartitions=1).withColumnRenamed("id", "ord")
    return domain.withColumn("log_level", F.get(F.array(*[F.lit(word) for word in words]), F.col("ord").cast("int")))


def in_order(counted: DataFrame) -> DataFrame:
    """A table by level in the order of the words."""
    return counted.orderBy("ord").drop("ord")


def counts_of(grouped: DataFrame, words: Sequence[str] = LEVELS) -> DataFrame:
    """``ord, log_level, count`` with a zero for each level that has no line.

    The grouped side holds one row per word and one for ``""``, whatever the input.
    """
    return (
        level_domain(grouped, words)
        .join(made_small(grouped, len(words) + 1), "log_level", "left")
        .select("ord", "log_level", F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))
    )


def counts(lines: DataFrame, words: Sequence[str] = LEVELS, header_only: bool = False) -> DataFrame:
    """``log_level, count`` for every level word, in the order of the words."""
    return in_order(counts_of(groups(lines, words, header_only), words))


def share_of(grouped: DataFrame, words: Sequence[str] = LEVELS) -> DataFrame:
    # The window runs over the level domain, one row per word.
    total = F.sum("count").over(Window.partitionBy())
    percent = F.when(total > 0, 100.0 * F.col("count") / total).otherwise(F.lit(0.0))
    return counts_of(grouped, words).withColumn("percent", percent)


def share(lines: DataFrame, words: Sequence[str] = LEVELS, header_only: bool = False) -> DataFrame:
    """``log_level, count, percent`` where percent is taken of the lines that have a level."""
    return in_order(share_of(groups(lines, words, header_only), words))


def _total_columns() -> list[Column]:
    has_level = F.col("log_level") != ""
    return [
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_lines"),
        F.coalesce(F.sum(F.when(has_level, F.col("count"))), F.lit(0)).alias("lines_with_level"),
        F.count_if(has_level).alias("distinct_levels"),
    ]


def totals_of(grouped: DataFrame) -> DataFrame:
    return grouped.agg(*_total_columns())


def totals(lines: DataFrame, words: Sequence[str] = LEVELS, header_only: bool = False) -> DataFrame:
    """One row: ``total_lines, lines_with_level, distinct_levels``."""
    return totals_of(groups(lines, words, header_only))


def distinct_levels(lines: DataFrame, words: Sequence[str] = LEVELS, header_only: bool = False) -> DataFrame:
    """The levels which occur."""
    return groups(lines, words, header_only).filter(_named("log_level", "count")).select("log_level")


def report_of(grouped: DataFrame, words: Sequence[str] = LEVELS, heading: str | None = None) -> DataFrame:
    """``ord, line``: the text report. ``heading`` is an optional first line of the caller's."""
    per_level = [
        F.coalesce(F.sum(F.when(F.col("log_level") == word, F.col("count"))), F.lit(0)).alias(f"n_{word}")
        for word in words
    ]
    one = grouped.agg(*_total_columns(), *per_level)
    with_level = F.col("lines_with_level")

    def level_line(word: str) -> Column:
        n = F.col(f"n_{word}")
        percent = F.when(with_level > 0, 100.0 * n / with_level).otherwise(F.lit(0.0))
        return F.format_string(LEVEL_LINE, F.lit(word), n, percent)

    lines = [
        *([F.lit(heading)] if heading is not None else []),
        F.concat(F.lit(LEVEL_HEADS[0]), count_text("total_lines")),
        F.concat(F.lit(LEVEL_HEADS[1]), count_text("lines_with_level")),
        F.concat(F.lit(LEVEL_HEADS[2]), F.col("distinct_levels").cast("string")),
        F.lit(""),
        F.lit(LEVEL_HEADS[3]),
        *[level_line(word) for word in words],
    ]
    return one.select(F.posexplode(F.array(*lines)).alias("ord", "line"))


def report(
    lines: DataFrame, words: Sequence[str] = LEVELS, heading: str | None = None, header_only: bool = False
) -> DataFrame:
    return report_of(groups(lines, words, header_only), words, heading)


def sample(
    lines: DataFrame,
    n: int = 10,
    seed: int = 42,
    key: Column | str | None = None,
    words: Sequence[str] = LEVELS,
    header_only: bool = False,
) -> DataFrame:
    """``log_entry, log_level`` of n lines that have a level.

    Without ``key`` the draw depends on the layout of the input. With ``key`` (a column that tells the
    rows apart) the same rows are drawn from any layout. Both keep n rows per task on the way.

    Lines without a level are put last and dropped from the n rows; to filter them first would run the
    pattern twice per line.
    """
    found = lines.withColumn("log_level", parse.level("value", words, header_only=header_only))
    if key is None:
        order = [F.rand(seed)]
    else:
        key = F.col(key) if isinstance(key, str) else key
        order = [F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), key]
    no_level = F.col("log_level") == ""
    drawn = found.orderBy(no_level, *order).limit(n).filter(~no_level)
    return drawn.select(F.col("value").alias("log_entry"), "log_level")


# Equal texts of a file are numbered in a task; a file's texts are dealt out to this many (two hexadecimal digits).
TEXT_GROUP_DIGITS = 2
# Numbers that one row is spread into at once.
NUMBERS_PER_ROW = 100_000


def sample_by_text(
    lines: DataFrame, n: int = 10, seed: int = 42, words: Sequence[str] = LEVELS, header_only: bool = False
) -> DataFrame:
    """``log_entry, log_level`` of n lines that have a level; the same ones from any layout, without a key column.

    Lines are told apart by their place among the lines of their file and of a group of texts, in the order of the
    texts. The first pass only counts these groups; places are drawn by arithmetic on the counts and written, n rows
    at most. The second pass reads the lines again, counts equal texts of the groups drawn, sums up the counts
    in the order of the texts and takes the texts in whose range a drawn place lies. Equal lines have neighbouring
    places, so each copy has a chance of its own. Texts are shuffled once each for a task, and those of other groups not at all;
    a group of any size is summed up in parts.
    """
    group = F.substring(F.md5("value"), 1, TEXT_GROUP_DIGITS).alias("text_group")
    level = parse.level("value", words, header_only=header_only).alias("log_level")
    found = lines.select("file_path", group, "value", level)
    counted = found.groupBy("file_path", "text_group").agg(F.count_if(F.col("log_level") != "").alias("n"))
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(NUMBERS_PER_ROW).cast("bigint")))
    last = F.least(F.col("first") + NUMBERS_PER_ROW, F.col("n")) - 1
    numbered = (
        counted.filter("n > 0")
        .withColumn("first", first)
        .select("file_path", "text_group", F.explode(F.sequence("first", last)).alias("number"))
    )
    key = F.concat_ws(":", F.lit(str(seed)), "file_path", "text_group", F.col("number").cast("string"))
    drawn = materialize(numbered.orderBy(F.md5(key), "file_path", "text_group", "number").limit(n), "places")
    keys = ["file_path", "text_group"]
    own = found.join(drawn.select(*keys).distinct(), keys, "left_semi").filter(F.col("log_level") != "")
    texts = own.groupBy(*keys, "value", "log_level").agg(F.count("*").alias("copies"))
    placed = sums_before(texts, keys, ["value"], "copies", "before", "texts")
    return (
        placed.join(drawn, keys)
        .filter((F.col("number") >= F.col("before")) & (F.col("number") < F.col("before") + F.col("copies")))
        .select(F.col("value").alias("log_entry"), "log_level")
    )


def occurrences(lines: DataFrame, words: Sequence[str] = LEVELS) -> DataFrame:
    """``log_level, count`` over every level word of every line, word boundaries not asked for.

    No word may lie in or overlap another, as holds for the level words, so a word's count is the length lost when it is cut out of the line, divided
    by its own. This equals counting ``parse.level_words`` and needs neither a pattern nor a row per word.
    """

    def found(word: str) -> Column:
        rest = F.replace(F.col("value"), F.lit(word), F.lit(""))
        lost = F.when(F.col("value").contains(word), F.octet_length("value") - F.octet_length(rest))
        return F.coalesce(F.sum(lost), F.lit(0)) / F.lit(len(word))

    one = lines.agg(*[found(word).cast("bigint").alias(word) for word in words])
    return one.unpivot([], list(words), "log_level", "count").filter("count > 0")
