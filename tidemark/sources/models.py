"""Saved models, addressed by name and stage.

``<root>/events`` is the registry's event table (one row per registration or
stage change); ``<root>/files/<name>/v=<n>`` holds a small description
and the saved pipeline, or the trees' nodes, of models that have them.  One writer per model is assumed.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.boosting import NODE_SCHEMA, BoostedModel, Trees
from tidemark.operators.qlearning import LinearQ, RandomFeatureQ
from tidemark.operators.registry import INITIAL_STAGE, latest_in_stage
from tidemark.operators.scoring import ForeignModel
from tidemark.session import path_exists

EVENT_SCHEMA = "name string, version bigint, stage string, event_seq bigint, uri string"
_ABOUT_SCHEMA = "kind string, about string"

# anything the registry holds: boosted trees, any pipeline, action values, models from outside Spark
Model = BoostedModel | PipelineModel | LinearQ | RandomFeatureQ | ForeignModel


class ModelNotFound(LookupError):
    """No version of the model is in the requested stage."""


def read_events(spark: SparkSession, root: str) -> DataFrame:
    """Registry events; an empty frame before the first registration."""
    if not path_exists(spark, f"{root}/events"):
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{root}/events")


def _append_event(spark: SparkSession, root: str, name: str, version: int, stage: str, uri: str) -> None:
    newest = read_events(spark, root).agg(F.coalesce(F.max("event_seq"), F.lit(0))).first()[0]
    row = spark.createDataFrame([(name, version, stage, newest + 1, uri)], EVENT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/events")


def save_artifact(model: Model, spark: SparkSession, uri: str) -> None:
    """Save a model without registering it: its description, and its pipeline if it has one."""
    pipeline = None
    if isinstance(model, BoostedModel):
        kind, about = "boosted", {"features": model.features, "classes": model.classes, "losses": model.losses}
        spark.createDataFrame(model.trees.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{uri}/trees")
    elif isinstance(model, PipelineModel):
        pipeline, kind, about = model, "pipeline", {}
    elif isinstance(model, LinearQ):
        kind, about = "linear_q", asdict(model)
    elif isinstance(model, RandomFeatureQ):
        kind, about = "random_feature_q", asdict(model)
    elif isinstance(model, ForeignModel):
        kind, about = "foreign", asdict(model)
    else:
        raise TypeError(f"cannot save a {type(model).__name__}")
    if pipeline is not None:
        pipeline.write().overwrite().save(f"{uri}/pipeline")
    row = spark.createDataFrame([(kind, json.dumps(about))], _ABOUT_SCHEMA)
    row.coalesce(1).write.mode("overwrite").json(f"{uri}/about")


def load_artifact(spark: SparkSession, uri: str) -> Model:
    row = spark.read.schema(_ABOUT_SCHEMA).json(f"{uri}/about").first()
    about = json.loads(row["about"])
    if row["kind"] == "linear_q":
        return LinearQ(tuple(map(tuple, about["weights"])), tuple(about["intercepts"]))
    if row["kind"] == "random_feature_q":
        return RandomFeatureQ(tuple(map(tuple, about["directions"])), tuple(about["offsets"]), tuple(map(tuple, about["weights"])))
    if row["kind"] == "foreign":
        return ForeignModel(tuple(about["features"]), about["loader"], about["settings"])
    if row["kind"] == "pipeline":
        return PipelineModel.load(f"{uri}/pipeline")
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{uri}/trees").toArrow()
    return BoostedModel(Trees(nodes), tuple(about["features"]), about["classes"], tuple(about["losses"]))


def register_model(model: Model, spark: SparkSession, root: str, name: str) -> int:
    """Save ``model`` as the next version of ``name`` in stage "None"."""
    versions = read_events(spark, root).filter(F.col("name") == name)
    version = versions.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
    uri = f"{root}/files/{name}/v={version}"
    save_artifact(model, spark, uri)
    _append_event(spark, root, name, version, INITIAL_STAGE, uri)
    return version


def transition_stage(spark: SparkSession, root: str, name: str, version: int, stage: str) -> None:
    """Record that ``version`` of ``name`` is now in ``stage``."""
    known = read_events(spark, root).filter((F.col("name") == name) & (F.col("version") == version)).first()
    if known is None:
        raise ModelNotFound(f"{name} has no version {version}")
    _append_event(spark, root, name, version, stage, known["uri"])


def load_model(spark: SparkSession, root: str, name: str, stage: str) -> Model:
    """Newest version of ``name`` in ``stage``."""
    row = latest_in_stage(read_events(spark, root), stage, name).first()
    if row is None:
        raise ModelNotFound(f"no version of {name} is in stage {stage}")
    return load_artifact(spark, row["uri"])
