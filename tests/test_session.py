from __future__ import annotations

from timberline.operators import levels
from timberline.session import SETTINGS, settings


def test_settings_in_force(spark):
    for key, value in SETTINGS.items():
        assert spark.conf.get(key) == value


def test_chosen_settings():
    chosen = settings(shuffle_partitions=2000, s3_credentials="a.Provider", spark__executor__memory="16g")
    assert chosen["spark.sql.shuffle.partitions"] == "2000"
    assert chosen["spark.hadoop.fs.s3a.aws.credentials.provider"] == "a.Provider"
    assert chosen["spark.executor.memory"] == "16g"
    assert chosen["spark.sql.session.timeZone"] == "UTC"
    # Shuffle partitions are left to adaptive execution unless they are given.
    assert "spark.sql.shuffle.partitions" not in settings()
    assert settings(spark__sql__adaptive__enabled="false")["spark.sql.adaptive.enabled"] == "false"


def test_small_results_as_pandas(lines):
    assert levels.counts(lines("INFO x")).toPandas().to_csv(index=False) == (
        "log_level,count\nINFO,1\nWARN,0\nERROR,0\nDEBUG,0\n"
    )
