"""Metric tables: gauges per job, and parameters and metrics per run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GAUGE_SCHEMA = "metric string, value double, help string, job string"
METRIC_SCHEMA = "run_id string, key string, step bigint, value double, ts timestamp"
PARAM_SCHEMA = "run_id string, key string, value string"


def push_gauges(gauges: DataFrame, path: str) -> None:
    """Replace all gauges of every job present in ``gauges``; other jobs keep theirs.

    ``gauges`` has columns ``job, metric, value`` and optionally ``help``.
    """
    helped = gauges if "help" in gauges.columns else gauges.withColumn("help", F.lit(None).cast("string"))
    (
        helped.select("metric", F.col("value").cast("double").alias("value"), "help", "job")
        .hint("rebalance", "job")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("job")
        .parquet(path)
    )


def read_gauges(spark: SparkSession, path: str) -> DataFrame:
    """Current gauges; a filter on ``job`` prunes to that job's folder."""
    return spark.read.schema(GAUGE_SCHEMA).parquet(path)


def log_metrics(metrics: DataFrame, path: str) -> None:
    """Append run metrics; ``step`` may be null."""
    columns = {f.split()[0]: f.split()[1] for f in METRIC_SCHEMA.split(", ")}
    filled = metrics
    if "step" not in metrics.columns:
        filled = filled.withColumn("step", F.lit(None))
    if "ts" not in metrics.columns:
        filled = filled.withColumn("ts", F.current_timestamp())
    filled.select(*[F.col(n).cast(t).alias(n) for n, t in columns.items()]).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).parquet(path)


def log_params(spark: SparkSession, run_id: str, params: Mapping[str, object], path: str) -> None:
    """Append one run's parameters as text."""
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    append_params(spark.createDataFrame(rows, PARAM_SCHEMA).coalesce(1), path)


def append_params(params: DataFrame, path: str) -> None:
    """Append the parameters of many runs (``run_id, key, value``)."""
    params.select("run_id", "key", F.col("value").cast("string").alias("value")).write.mode("append").parquet(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAM_SCHEMA).parquet(path)
