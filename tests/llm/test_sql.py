"""Queries that SQL can express, over whole tables."""

from __future__ import annotations

import pytest

from tests.compare import assert_same, connect
from timberline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) > 0
