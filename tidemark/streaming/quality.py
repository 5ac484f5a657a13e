"""Model quality on streams: predictions joined with truth that comes later, or never."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WINDOW_SIZE = "1 hour"
WATERMARK = "15 minutes"
PATIENCE = "1 hour"


def with_truth(
    predictions: DataFrame, truth: DataFrame, key: str, label: str, predicted_at: str, known_at: str, patience: str = PATIENCE, watermark: str = WATERMARK
) -> DataFrame:
    """Predictions with the truth that comes within ``patience``, else with a null label; batch and stream.

    On streams both sides are kept until their watermarks say that no partner can
    come any more; then a prediction without truth is given out alone.
    """
    sides = []
    for side, time in ((predictions, predicted_at), (truth.select(key, label, known_at), known_at)):
        timed = side.withColumn(time, F.col(time).cast("timestamp"))
        sides.append(timed.withWatermark(time, watermark) if timed.isStreaming else timed)
    asked, told = sides[0], sides[1].withColumnRenamed(key, "_key")
    in_time = F.col(known_at).between(F.col(predicted_at), F.col(predicted_at) + F.expr(f"INTERVAL {patience}"))
    return asked.join(told, (F.col(key) == F.col("_key")) & in_time, "left_outer").drop("_key")


def quality_counts(joined: DataFrame, label: str, predicted_at: str, prediction: str = "prediction", size: str = WINDOW_SIZE) -> DataFrame:
    """Rows per time window, label (null: never told) and prediction: what all quality figures are made of."""
    counted = joined.groupBy(F.window(predicted_at, size).alias("_window"), label, prediction).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.col("_window.start").alias("window_start"), label, prediction, "rows")


def quality_by_window(counts: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Per window: rows, rows without truth, right ones, and accuracy among those with truth."""
    known = F.col(label).isNotNull()
    right = F.sum(F.when(known & (F.col(label) == F.col(prediction)), F.col("rows")).otherwise(0))
    told = F.sum(F.when(known, F.col("rows")).otherwise(0))
    summed = counts.groupBy("window_start").agg(F.sum("rows").alias("rows"), (F.sum("rows") - told).alias("untold"), right.alias("right"))
    return summed.withColumn("accuracy", F.try_divide(F.col("right"), F.col("rows") - F.col("untold")))


def quality_stream(
    predictions: DataFrame,
    truth: DataFrame,
    key: str,
    label: str,
    predicted_at: str,
    known_at: str,
    output: str,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    patience: str = PATIENCE,
    watermark: str = WATERMARK,
    prediction: str = "prediction",
    available_now: bool = True,
) -> StreamingQuery:
    """Write the counts of every closed window to ``output``, each once.

    Counting follows the join in the same query; a window closes once no
    prediction of it can still be waiting for its truth.
    """
    joined = with_truth(predictions, truth, key, label, predicted_at, known_at, patience, watermark)
    writer = (
        quality_counts(joined, label, predicted_at, prediction, size)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
