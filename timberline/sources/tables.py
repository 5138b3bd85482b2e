"""Generated ids, SQL views, table profiles and result files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Result files are read with these types; nothing is inferred, so ids stay text.
TIMELINE_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("application_id", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
    ]
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("cluster_id", T.StringType()),
        T.StructField("num_applications", T.LongType()),
        T.StructField("cluster_first_app", T.TimestampNTZType()),
        T.StructField("cluster_last_app", T.TimestampNTZType()),
    ]
)


def generated_range(spark: SparkSession, n: int) -> DataFrame:
    """Ids from 0 to n-1."""
    return spark.range(n)


def count_sql(df: DataFrame, view: str | None = None) -> DataFrame:
    """Row count by SQL over a temporary view; without a name over one that no caller has."""
    view = view or f"counted_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(f"SELECT count(*) AS total FROM {view}")


def profile(df: DataFrame, source: str) -> DataFrame:
    """``source, n_rows, n_cols``; ``preview`` and ``df.schema`` give the rest of a first look."""
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(source).alias("source"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Result CSV of the sinks. An empty field is null, and so is a field which does not fit its type."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
