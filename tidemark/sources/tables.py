"""Versioned Parquet tables with replace-schema and keep-schema overwrite.

Layout: ``<path>/data/v=<n>`` holds one snapshot; ``<path>/commits`` holds one
JSON row per published snapshot.  A snapshot counts only once its commit row
exists, so readers never see a half-written table and a table may be
overwritten from a query that reads it.  One writer per table is assumed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import path_exists

_COMMIT_SCHEMA = "version bigint, schema string"


class SchemaMismatch(ValueError):
    """A keep-schema overwrite was given different columns or types."""


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _latest_commit(spark: SparkSession, path: str):
    if not path_exists(spark, f"{path}/commits"):
        return None
    commits = spark.read.schema(_COMMIT_SCHEMA).json(f"{path}/commits")
    newest = commits.agg(F.max_by(F.struct("version", "schema"), "version").alias("c")).first()
    return newest["c"]


def latest_version(spark: SparkSession, path: str) -> int | None:
    commit = _latest_commit(spark, path)
    return commit["version"] if commit else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Latest published snapshot."""
    commit = _latest_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no published table at {path}")
    schema = T.StructType.fromJson(json.loads(commit["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/data/v={commit['version']}")


def overwrite_table(df: DataFrame, path: str, replace_schema: bool = False) -> int:
    """Publish ``df`` as the next snapshot and return its version.

    Without ``replace_schema`` a change of column names, order or types against
    the current snapshot raises ``SchemaMismatch`` before anything is written.
    """
    spark = df.sparkSession
    commit = _latest_commit(spark, path)
    if commit and not replace_schema:
        current = T.StructType.fromJson(json.loads(commit["schema"]))
        if _shape(current) != _shape(df.schema):
            raise SchemaMismatch(f"{_shape(df.schema)} does not match {_shape(current)}")
    version = (commit["version"] if commit else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/data/v={version}")
    marker = spark.createDataFrame([(version, df.schema.json())], _COMMIT_SCHEMA)
    marker.coalesce(1).write.mode("append").json(f"{path}/commits")
    return version
