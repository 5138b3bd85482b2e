from __future__ import annotations

from pyspark.sql import functions as F

from timberline.functions import parse
from timberline.operators import levels
from timberline.plans import standins


def rows(df):
    return [tuple(row) for row in df.collect()]


LOG = [
    "17/03/29 10:04:43 INFO a: one",
    "17/03/29 10:04:44 INFO a: two",
    "17/03/29 10:04:45 WARN a: saw ERROR",
    "    INFORMATION frame",
    "",
]


def test_counts_fill_the_domain(lines):
    assert rows(levels.counts(lines(*LOG))) == [("INFO", 2), ("WARN", 1), ("ERROR", 0), ("DEBUG", 0)]


def test_other_words(lines):
    assert rows(levels.counts(lines("FATAL x", "INFO y"), ["FATAL", "INFO", "TRACE"])) == [
        ("FATAL", 1),
        ("INFO", 1),
        ("TRACE", 0),
    ]


def test_totals_share_distinct(lines):
    df = lines(*LOG)
    assert rows(levels.totals(df)) == [(5, 3, 2)]
    assert [(lvl, n, round(p, 4)) for lvl, n, p in rows(levels.share(df))] == [
        ("INFO", 2, 66.6667),
        ("WARN", 1, 33.3333),
        ("ERROR", 0, 0.0),
        ("DEBUG", 0, 0.0),
    ]
    assert sorted(rows(levels.distinct_levels(df))) == [("INFO",), ("WARN",)]


def test_empty_table(lines):
    empty = lines("x").limit(0)
    assert rows(levels.totals(empty)) == [(0, 0, 0)]
    assert rows(levels.counts(empty)) == [("INFO", 0), ("WARN", 0), ("ERROR", 0), ("DEBUG", 0)]
    assert {p for _, _, p in rows(levels.share(empty))} == {0.0}
    assert rows(levels.report(empty))[-1] == (8, "  DEBUG:            0 (  0.00%)")


def test_report_has_the_published_form(spark):
    grouped = spark.createDataFrame(
        [("INFO", 27389482), ("WARN", 9595), ("ERROR", 11259), ("", 33236604 - 27410336)], "log_level string, count long"
    )
    assert [line for _, line in sorted(rows(levels.report_of(grouped, heading="Label: x")))] == [
        "Label: x",
        "Total log lines processed: 33,236,604",
        "Total lines with log levels: 27,410,336",
        "Unique log levels found: 3",
        "",
        "Log level distribution:",
        "  INFO :   27,389,482 ( 99.92%)",
        "  WARN :        9,595 (  0.04%)",
        "  ERROR:       11,259 (  0.04%)",
        "  DEBUG:            0 (  0.00%)",
    ]


def test_levels_add_up(lines):
    df = lines(*LOG)
    total = levels.totals(df).collect()[0]
    assert sum(n for _, n in rows(levels.counts(df))) == total.lines_with_level
    assert sum(n for _, n in rows(levels.groups(df))) == total.total_lines


def test_keyed_sample_is_the_same_from_any_layout(spark):
    df = spark.range(500).select(
        F.col("id").alias("k"), F.concat(F.when(F.col("id") % 3 == 0, "x").otherwise("WARN"), F.lit(" "), "id").alias("value")
    )
    draws = [rows(levels.sample(df.repartition(n), 7, key="k")) for n in (1, 8)]
    assert draws[0] == draws[1]
    assert len(draws[0]) == 7
    assert all(level == "WARN" for _, level in draws[0])
    assert rows(levels.sample(df, 7, seed=1, key="k")) != draws[0]


def test_sample_larger_than_the_lines_with_a_level(lines):
    assert len(levels.sample(lines(*LOG), 10).collect()) == 3


def test_occurrences_equal_the_words_of_the_lines(spark, sf_dir):
    logs = standins.logs(spark, sf_dir)
    words = logs.select(F.explode(parse.level_words()).alias("log_level")).groupBy("log_level").count()
    assert sorted(rows(levels.occurrences(logs))) == sorted(rows(words))


def test_occurrences_count_each_word(lines):
    got = dict(rows(levels.occurrences(lines("INFO x WARN INFORMATION", "nothing"))))
    assert got == {"INFO": 2, "WARN": 1}
    assert rows(levels.occurrences(lines("é INFOINFO ü").limit(1))) == [("INFO", 2)]
    assert rows(levels.occurrences(lines("INFO").limit(0))) == []


def test_sample_by_text_is_the_same_from_any_layout(spark):
    df = spark.createDataFrame([(f"f{i % 3}", f"INFO text {i % 40}") for i in range(300)], "file_path string, value string")
    draws = [rows(levels.sample_by_text(df.repartition(n), 12)) for n in (1, 8)]
    assert draws[0] == draws[1] and len(draws[0]) == 12
    assert rows(levels.sample_by_text(df, 12, seed=1)) != draws[0]


def test_each_copy_of_a_line_has_its_own_chance(spark):
    """Fifty equal and fifty different lines: a fair draw of ten takes five of each on average."""
    df = spark.createDataFrame([("f", "INFO same" if i < 50 else f"INFO other {i}") for i in range(100)], "file_path string, value string").cache()
    equal = [sum(row.log_entry == "INFO same" for row in levels.sample_by_text(df, 10, seed=seed).collect()) for seed in range(40)]
    df.unpersist()
    assert 4.2 < sum(equal) / len(equal) < 5.8
    # All or nothing would be far from this.
    assert sum(2 <= n <= 8 for n in equal) >= 36


def test_lines_without_a_level_are_not_drawn(lines):
    assert levels.sample_by_text(lines("no level", "INFO x"), 5).collect()[0].log_entry == "INFO x"
    assert levels.sample_by_text(lines("no level"), 5).collect() == []


def test_header_only_everywhere(lines):
    table = lines("17/03/29 10:00:00 INFO a: says ERROR", "says ERROR", "17/03/29 10:00:00 WARN a: b")
    assert levels.totals(table, header_only=True).first().lines_with_level == 2
    assert {row.log_level for row in levels.distinct_levels(table, header_only=True).collect()} == {"INFO", "WARN"}
    assert {row.log_level: row.percent for row in levels.share(table, header_only=True).collect()}["INFO"] == 50.0
    assert levels.report(table, header_only=True).collect()[1].line.endswith("2")
    assert len(levels.sample(table, header_only=True).collect()) == 2
    assert {row.log_level: row["count"] for row in levels.occurrences(table, ("says", "WARN")).collect()} == {"says": 2, "WARN": 1}
