from __future__ import annotations

import random

import pytest

# Columns that operators make themselves; a table may have its own of these names.
CLASHING = ["row", "score", "spans", "kept", "class_id", "shard", "slot", "piece", "base", "label", "items", "n_words", "place", "lang"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text)``, with further columns whose names clash with those of results."""

    def make(rows, extra=CLASHING):
        filled = [(doc_id, text, *[f"{name}-{i}" for name in extra]) for i, (doc_id, text) in enumerate(rows)]
        return spark.createDataFrame(filled, ", ".join(["doc_id long", "text string", *[f"{name} string" for name in extra]]))

    return make


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 7))) for _ in range(words))


#: Null id, null, empty and blank texts, a repeated row, equal texts, a very long text and a very long word.
ODD = [
    (None, "a text of a row that has no id"),
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one repeated row of ten words or so in it"),
    (4, "one repeated row of ten words or so in it"),
    (5, prose(1, 120)),
    (6, prose(1, 120)),
    (7, prose(2, 60_000)),
    (8, "x" * 300_000),
    (9, "Ünïcödé \U0001f600 wörds, ÄÖÜ   and \x85 blanks"),
    (10, "short"),
]
