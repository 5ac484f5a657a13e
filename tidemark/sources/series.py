"""CSV time-series scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import column, nan_to_null

ON_BAD_DATE = ("raise", "null")


def _parsed(date: Column, kind: T.DataType, formats: Sequence[str], on_bad_date: str) -> Column:
    """``date`` as a timestamp by the first format that fits; without formats, by the usual ISO forms."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return date.cast("timestamp")
    text = date.cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats] or [F.try_to_timestamp(text)]
    if on_bad_date == "raise":
        refused = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("timestamp")
        tries.append(F.when(F.trim(text) != "", refused))
    return F.coalesce(*tries)


def read_series_csv(
    spark: SparkSession,
    path: str,
    date_column: str = "date",
    schema: T.StructType | None = None,
    date_formats: str | Sequence[str] = (),
    on_bad_date: str = "raise",
) -> DataFrame:
    """Header CSV with typed columns and ``date_column`` as a timestamp.

    ``date_formats`` are Spark datetime patterns such as ``d-MMM-yy``, tried in
    turn.  A date text that fits none is an error, or null with
    ``on_bad_date="null"``; an empty one is null.  Types are inferred unless
    ``schema`` is given; give one for large inputs, since inference reads the
    files twice.
    """
    if on_bad_date not in ON_BAD_DATE:
        raise ValueError(f"on_bad_date must be one of {ON_BAD_DATE}")
    formats = [date_formats] if isinstance(date_formats, str) else list(date_formats)
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    scanned = reader.csv(path)
    date = _parsed(column(date_column), scanned.schema[date_column].dataType, formats, on_bad_date)
    return nan_to_null(scanned.withColumn(date_column, date))
