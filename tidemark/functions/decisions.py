"""Decisions taken on model outputs: argmax, thresholds, gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the training and monitoring jobs
DECISION_THRESHOLD = 0.5
MINIMUM_ACCURACY = 0.52
DRIFT_LEVEL = 0.05


def argmax(scores: Column) -> Column:
    """Index of the largest element, counting from 0; the first wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def best_value(scores: Column) -> Column:
    return F.array_max(scores)


def replace_element(values: Column, index: Column, value: Column) -> Column:
    """``values`` with the element at 0-based ``index`` replaced."""
    return F.transform(values, lambda v, i: F.when(i == index, value).otherwise(v))


def _given(value: Column) -> Column:
    """NaN as null: NaN orders above every number, a missing value passes no comparison."""
    return F.when(~F.isnan(value), value)


def binary_decision(probability: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """1 above the threshold, else 0; a missing probability decides 0."""
    return F.coalesce(_given(probability) > F.lit(threshold), F.lit(False)).cast("int")


def registration_gate(accuracy: Column, minimum: float = MINIMUM_ACCURACY) -> Column:
    """``register`` at or above the minimum accuracy, else ``artifact_only``, also for a missing accuracy."""
    return F.when(_given(accuracy) >= F.lit(minimum), "register").otherwise("artifact_only")


def drift_flag(p_value: Column, level: float = DRIFT_LEVEL) -> Column:
    """True when the p-value suggests drift; a missing p-value does not."""
    return F.coalesce(_given(p_value) < F.lit(level), F.lit(False))
