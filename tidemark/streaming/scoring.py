"""Streaming request scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.boosting import BoostedModel
from tidemark.operators.registry import latest_in_stage
from tidemark.operators.scoring import score_requests
from tidemark.sources.models import load_artifact, read_events


def read_request_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving under ``path`` (a folder or a glob) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def score_stream(
    requests: DataFrame,
    features: Sequence[str],
    model: BoostedModel | None,
    output: str,
    checkpoint: str,
    body: str = "body",
    available_now: bool = True,
) -> StreamingQuery:
    """Score a request stream into Parquet files at ``output``, each request once."""
    writer = (
        score_requests(requests, features, model, body)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def score_stream_by_stage(
    requests: DataFrame,
    features: Sequence[str],
    root: str,
    name: str,
    stage: str,
    output: str,
    checkpoint: str,
    body: str = "body",
    available_now: bool = True,
) -> StreamingQuery:
    """Score every micro-batch with the newest version of ``name`` in ``stage`` at that time.

    The registry is asked once per micro-batch, a version is loaded once per
    stream, and ``model_version`` says which one scored a row (null: none was in
    the stage).  A micro-batch overwrites its own folder, so a replayed one adds
    no rows.
    """
    loaded: dict[int, object] = {}

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = latest_in_stage(read_events(spark, root), stage, name).first()
        if newest is not None and newest["version"] not in loaded:
            loaded.clear()
            loaded[newest["version"]] = load_artifact(spark, newest["uri"])
        version = newest["version"] if newest is not None else None
        scored = score_requests(batch, features, loaded.get(version), body)
        scored.withColumn("model_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(score)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
