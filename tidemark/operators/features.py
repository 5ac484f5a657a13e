"""Scaling, time-series labels and label encoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column, numeric_names
from tidemark.operators.ordering import OrderedLayout, lay_out, row_position

# label lists up to this length become a literal in the plan
_LITERAL_CLASSES = 256


def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None, fit_on: Column | None = None) -> DataFrame:
    """One row of ``<c>_mean`` and ``<c>_scale`` (population deviation; 1 for a constant column).

    ``fit_on`` restricts fitting to some rows, for example the training split.
    """
    names = list(columns or numeric_names(df))
    source = df.filter(fit_on) if fit_on is not None else df
    stats = []
    for name in names:
        value = column(name).cast("double")
        value = F.when(~F.isnan(value), value)
        stats.append(F.avg(value).alias(f"{name}_mean"))
        spread = F.stddev_pop(value)
        stats.append(F.coalesce(F.nullif(spread, F.lit(0.0)), F.lit(1.0)).alias(f"{name}_scale"))
    return source.agg(*stats)


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - mean) / scale`` under the same names; missing stays missing.

    The one-row scaler enters the plan as a scalar subquery, so there is no join.
    """
    packed = scaler.select(F.struct(*[column(c) for c in scaler.columns])).scalar()
    return df.withColumns(
        {c: (column(c).cast("double") - packed[f"{c}_mean"]) / packed[f"{c}_scale"] for c in columns}
    )


def _direction(following: Column, current: Column) -> Column:
    """1 when the next value is greater; comparisons with a missing value are 0."""
    known = ~F.isnan(following.cast("double")) & ~F.isnan(current.cast("double"))
    return F.coalesce(known & (following > current), F.lit(False)).cast("bigint")


def next_direction(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), name: str = "target"
) -> DataFrame:
    """Label each row 1 when the next row's ``value`` is greater, else 0; the last row is kept with 0."""
    laid = lay_out(df, order, by).with_next(_following=column(value))
    return laid.rows().withColumn(name, _direction(F.col("_following"), column(value))).drop("_following")


def previous_value(
    df: DataFrame, value: str, order: Sequence[str], by: Sequence[str] = (), name: str = "previous"
) -> DataFrame:
    """``value`` of the preceding row; null on the first."""
    return lay_out(df, order, by).with_previous(**{name: F.col(value)}).rows()


def with_next_state(layout: OrderedLayout, state: str, width: int) -> OrderedLayout:
    """Add ``next_state`` (zeros after the last step) and ``done`` to a layout holding ``state`` arrays."""
    ahead = layout.with_next(_ahead=F.col(state), _more=F.lit(True))
    zeros = F.array_repeat(F.lit(0.0), width)
    done = F.col("_more").isNull()
    widened = ahead.with_columns(next_state=F.when(done, zeros).otherwise(F.col("_ahead")), done=done)
    return replace(widened, df=widened.df.drop("_ahead", "_more"))


def next_state(
    df: DataFrame, state: str, width: int, order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    return with_next_state(lay_out(df, order, by), state, width).rows()


def label_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Sorted distinct labels numbered from 0; one row per class."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return row_position(classes, [label], name="_rank").select(
        label, (F.col("_rank") - 1).cast("int").alias(code)
    )


def encode_labels(df: DataFrame, label: str, name: str = "target") -> DataFrame:
    """Replace sorted distinct labels by 0..k-1, numbers in numeric order and text in text order."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    known = [row[0] for row in classes.limit(_LITERAL_CLASSES + 1).collect()]
    if 0 < len(known) <= _LITERAL_CLASSES:
        kind = df.schema[label].dataType
        ordered = F.array_sort(F.array(*[F.lit(v).cast(kind) for v in known]))
        position = F.array_position(ordered, F.col(label)) - 1
        return df.withColumn(name, position.cast("int"))
    codes = label_codes(df, label, "_code").withColumnRenamed(label, "_label")
    return (
        df.join(codes, F.col(label) == F.col("_label"), "left")
        .withColumn(name, F.col("_code"))
        .drop("_label", "_code")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of each key by aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in rest])

