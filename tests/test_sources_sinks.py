from __future__ import annotations

import datetime as dt
import glob
import importlib

import pytest
from pyspark.sql import functions as F

from timberline import sinks, sources
from timberline.functions import parse
from timberline.operators import basics, messages
from timberline.session import clean_scratch, materialize, scratch_path, scratch_root


@pytest.fixture
def log_dir(tmp_path):
    files = {
        "application_1_0001/container_1_0001_01_000001.log": ["17/03/29 10:00:00 INFO a: x", "17/03/29 10:00:01 WARN a: y"],
        "application_1_0001/container_1_0001_01_000002.log": ["ERROR z"],
        "application_1_0002/container_1_0002_01_000001.log": ["INFO of application_1_0002"],
        "application_1_0002/stderr.txt": ["INFO other"],
        "application_x_y/container.log": ["DEBUG stray"],
        "README": ["INFO top"],
    }
    for name, content in files.items():
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_text("".join(line + "\n" for line in content))
    (tmp_path / "application_1_0003").mkdir()
    return str(tmp_path)


def test_read_logs(spark, log_dir):
    logs = sources.read_logs(spark, log_dir)
    assert logs.columns == ["file_path", "value"]
    assert logs.count() == 5
    got = logs.filter(F.col("value") == "ERROR z").select(parse.container_id()).collect()[0][0]
    assert got == "container_1_0001_01_000002"


def test_one_level_scan_takes_every_file(spark, log_dir):
    # Folders and files right below the path, with any name, are matched.
    assert sources.read_logs(spark, log_dir, "*").count() == 7
    assert sources.read_logs(spark, log_dir + "/application_1_0002/", None).count() == 2


def test_inventory_and_catalog(spark, log_dir):
    files = sources.file_inventory(spark, log_dir)
    assert files.agg(F.count("*"), F.sum("length")).collect()[0][0] == 6
    catalog = sorted(tuple(row) for row in sources.app_catalog(files).collect())
    assert catalog == [("1", "application_1_0001", "0001"), ("1", "application_1_0002", "0002")]
    logs_only = sources.file_inventory(spark, log_dir, "*.log")
    assert logs_only.count() == 4
    sizes = {row.application_id: (row.containers, row.bytes) for row in messages.app_bytes(logs_only).collect()}
    assert sizes == {"application_1_0001": (2, 64), "application_1_0002": (1, 27)}
    stats = messages.app_size_stats(messages.app_bytes(logs_only)).collect()[0]
    assert (stats.min_bytes, stats.max_bytes, stats.avg_bytes) == (27, 64, 45.5)


def test_inventory_opens_no_file(spark, log_dir):
    plan = sources.file_inventory(spark, log_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def test_month_paths():
    assert sources.month_paths("s3a://b/trips/", 2021, [1, 12]) == [
        "s3a://b/trips/yyyy=2021/yellow_tripdata_2021-01.parquet",
        "s3a://b/trips/yyyy=2021/yellow_tripdata_2021-12.parquet",
    ]


def test_trip_files(spark, tmp_path):
    root = str(tmp_path / "trips")
    for year, month in ((2021, 1), (2021, 2), (2022, 1)):
        path = sources.month_paths(root, year, [month])[0]
        spark.range(month * 10).withColumn("y", F.lit(year)).write.parquet(path)
    assert sources.read_trips(spark, sources.month_paths(root, 2021, [1, 2])).count() == 30
    below = sources.read_trips_below(spark, root, 2021)
    assert "yyyy" in below.columns and below.count() == 30
    assert all("/yyyy=2021/" in path for path in below.inputFiles())
    listed = sources.read_trips(spark, sources.month_paths(root, 2022, [1]), base_path=root)
    assert listed.select("yyyy").distinct().collect()[0].yyyy == 2022


def test_profile_and_preview(spark):
    df = spark.range(7).withColumn("x", F.lit("a"))
    assert tuple(sources.profile(df, "seven").collect()[0]) == ("seven", 7, 2)
    assert sources.preview(df).count() == 5


def test_first_operations(spark):
    ids = sources.generated_range(spark, 1000)
    assert sources.count_sql(ids, "ids_counted").collect()[0].total == 1000
    doubled = basics.even_doubled(ids)
    assert doubled.count() == 500
    assert doubled.agg(F.max("doubled")).collect()[0][0] == 1996


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ("1440487435730", 'application_"1", x', dt.datetime(2017, 3, 29, 10, 0, 0), None),
        ("1440487435731", "  blanks kept  ", None, None),
    ]
    df = spark.createDataFrame(rows, sources.TIMELINE_SCHEMA)
    path = str(tmp_path / "out")
    sinks.write_csv(df.coalesce(1), path)
    (part,) = glob.glob(path + "/*.csv")
    assert open(part).read().splitlines() == [
        "cluster_id,application_id,start_time,end_time",
        '1440487435730,"application_""1"", x",2017-03-29 10:00:00,',
        "1440487435731,  blanks kept  ,,",
    ]
    back = sources.read_results(spark, path, sources.TIMELINE_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows))


def test_bad_fields_are_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cluster_id,application_id,start_time,end_time\n1,x,never,2017-03-29 10:00:00\n")
    got = sources.read_results(spark, str(tmp_path), sources.TIMELINE_SCHEMA).collect()
    assert tuple(got[0]) == ("1", "x", None, dt.datetime(2017, 3, 29, 10, 0))


def test_lines_keep_their_order(spark, tmp_path):
    report = spark.range(50).select(F.col("id").alias("ord"), F.concat(F.lit("line "), "id").alias("line")).repartition(7)
    path = str(tmp_path / "report")
    sinks.write_lines(report, path)
    (part,) = glob.glob(path + "/*.txt")
    assert open(part).read().splitlines() == [f"line {i}" for i in range(50)]


def test_one_scratch_rule_for_all_masters(monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = {"spark.sql.warehouse.dir": "hdfs://n/warehouse"} | values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        def __init__(self, name):
            self.applicationId, self._jsc = name, None

    class Session:
        def __init__(self, name, **values):
            self.conf, self.sparkContext = Conf(values), Context(name)

    monkeypatch.setattr(importlib.import_module("timberline.session"), "_roots", {})
    for master in ("spark://n:7077", "local[2]", "local-cluster[2,1,1024]"):
        shared = Session("a" + master, **{"spark.checkpoint.dir": "hdfs://n/shared/", "spark.master": master})
        assert scratch_path(shared, "t").startswith("hdfs://n/shared/session-")
        unset = Session("b" + master, **{"spark.master": master})
        first, second = (scratch_path(unset, "t") for _ in range(2))
        assert first.startswith("hdfs://n/warehouse/scratch/session-")
        assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_materialize(spark):
    df = spark.range(10).withColumn("x", F.lit("a"))
    kept = materialize(df, "ten")
    assert kept.dtypes == df.dtypes and kept.count() == 10


def test_clean_up_leaves_no_folder(spark):
    materialize(spark.range(3), "three")
    root = scratch_root(spark).removeprefix("file:")
    assert glob.glob(root + "/three-*/*.parquet")
    clean_scratch(spark)
    assert not glob.glob(root)
