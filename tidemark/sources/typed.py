"""Typed ingest: values are cast field by field under an explicit schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def labelled_schema(features: Sequence[str], target: str = "target", target_name: str = "target_name") -> T.StructType:
    """Double features, an int label and its text name, all nullable."""
    fields = [T.StructField(f, T.DoubleType(), True) for f in features]
    fields.append(T.StructField(target, T.IntegerType(), True))
    fields.append(T.StructField(target_name, T.StringType(), True))
    return T.StructType(fields)


def ingest_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to ``schema``; columns outside it are dropped, bad values become null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def ingest_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A small in-memory row list under ``schema``; convert large inputs with ``ingest_typed``."""
    casts = {T.DoubleType: float, T.IntegerType: int, T.StringType: str}
    convert = [casts.get(type(f.dataType), lambda v: v) for f in schema.fields]
    typed = [tuple(None if v is None else c(v) for c, v in zip(convert, row)) for row in rows]
    return spark.createDataFrame(typed, schema=schema)
