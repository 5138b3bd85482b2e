from __future__ import annotations

import os

import pytest

from timberline.session import session

SF_ROOT = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", master="local[8]", shuffle_partitions=8, spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small_dir():
    path = f"{SF_ROOT}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("tables are not there")
    return path


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{SF_ROOT}/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("tables are not there")
    return path


@pytest.fixture
def lines(spark):
    """Line table from texts, all of one file unless a path is given."""

    def make(*rows):
        default = "file:/logs/application_1485248649253_0052/container_1485248649253_0052_01_000002.log"
        rows = [row if isinstance(row, tuple) else (default, row) for row in rows]
        return spark.createDataFrame(rows, "file_path string, value string")

    return make
