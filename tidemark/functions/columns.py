"""Column-level operators: selection, casts, cleaning, vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str) -> Column:
    """The column of exactly this name, also one with dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep ``keep`` and every numeric column; text, boolean and date columns go."""
    names = [n for n in numeric_names(df) if n not in keep]
    return df.select(*[column(n) for n in (*keep, *names)])


def project(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """Features in the given order, then the label."""
    return df.select(*[column(n) for n in (*features, *([label] if label else []))])


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value instead of two: NaN orders above every number, null does not."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: F.when(~F.isnan(column(n)), column(n)) for n in floats})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop every row holding a null or NaN in any column."""
    complete = F.lit(True)
    for f in df.schema.fields:
        complete = complete & column(f.name).isNotNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            complete = complete & ~F.isnan(column(f.name))
    return df.filter(complete)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by column name; a value that does not convert becomes null."""
    return df.withColumns({name: column(name).try_cast(kind) for name, kind in types.items()})


def to_vector(columns: Sequence[str]) -> Column:
    """Columns as ``array<double>`` in the given order; by convention the price comes first."""
    return F.array(*[column(c).cast("double") for c in columns])


def metric_key(feature: Column | str, suffix: str) -> Column:
    """Gauge name such as ``<feature>_p_value``, with ``-`` replaced by ``_``."""
    name = column(feature) if isinstance(feature, str) else feature
    return F.translate(F.concat(name, F.lit(f"_{suffix}")), "-", "_")
