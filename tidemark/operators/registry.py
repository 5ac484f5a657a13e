"""Model registry and run comparison as queries over event and metric tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import latest_per_key
from tidemark.operators.ordering import row_position

INITIAL_STAGE = "None"


def stage_state(events: DataFrame) -> DataFrame:
    """Current stage of each version: the newest event per (name, version).

    ``events`` holds ``name, version, stage, event_seq`` and any further columns.
    """
    return latest_per_key(events, ["name", "version"], ["event_seq"])


def latest_in_stage(events: DataFrame, stage: str, name: str | None = None) -> DataFrame:
    """Newest version of each model now in ``stage``; empty when there is none."""
    # only whole names may be filtered before the newest event per version is known
    known = events.filter(F.col("name") == name) if name is not None else events
    current = stage_state(known).filter(F.col("stage") == stage)
    return latest_per_key(current, ["name", "stage"], ["version"])


def transition(version_rows: DataFrame, stage: str, event_seq: Column | int) -> DataFrame:
    """Event rows that move the given versions to ``stage``; append them to the events."""
    sequence = event_seq if isinstance(event_seq, Column) else F.lit(event_seq)
    return version_rows.withColumns({"stage": F.lit(stage), "event_seq": sequence.cast("bigint")})


def register(registrations: DataFrame, existing: DataFrame | None = None, order: Sequence[str] = ("event_seq",)) -> DataFrame:
    """Number new versions of each model from max + 1 (from 1 for a new model), in ``order``.

    ``registrations`` holds ``name`` and the order columns; new rows start in stage "None".
    """
    numbered = row_position(registrations, list(order), by=["name"], name="_nth")
    if existing is None:
        versioned = numbered.withColumn("version", F.col("_nth"))
    else:
        newest = existing.groupBy("name").agg(F.max("version").alias("_newest"))
        versioned = numbered.join(newest, "name", "left").withColumn(
            "version", F.coalesce(F.col("_newest"), F.lit(0)) + F.col("_nth")
        ).drop("_newest")
    return versioned.drop("_nth").withColumn("stage", F.lit(INITIAL_STAGE))


def next_versions(existing: DataFrame) -> DataFrame:
    """Version that the next registration of each model gets."""
    return existing.groupBy("name").agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version"))


def model_ready(events: DataFrame, name: str, stage: str) -> DataFrame:
    """One row: is any version of ``name`` now in ``stage``?"""
    found = latest_in_stage(events, stage, name).limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("ready")).select(
        F.lit(name).alias("name"), F.lit(stage).alias("stage"), "ready"
    )


def compare_runs(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with the last value of each metric in ``keys``.

    Last means the highest step, then the newest timestamp.  Naming the keys
    lets the pivot run as one aggregation with a map-side part.
    """
    last = F.max_by("value", F.struct("step", "ts"))
    return metrics.groupBy("run_id").pivot("key", list(keys)).agg(last)
