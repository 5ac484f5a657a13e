"""Drift tests on closed time windows of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import column
from tidemark.operators.drift import (
    ks_against_steps,
    reference_counts,
    reference_steps,
    value_bucket,
    window_value_counts,
    with_error_bound,
    with_p_value,
)
from tidemark.session import materialise, scratch_scope

# schedule of the monitoring job; late rows are waited for just as long
WINDOW_SIZE = "15 minutes"
WATERMARK = "15 minutes"


def drift_stream(
    production: DataFrame,
    reference: DataFrame,
    value: str,
    time: str,
    output: str,
    checkpoint: str,
    size: str = WINDOW_SIZE,
    watermark: str = WATERMARK,
    available_now: bool = True,
    accuracy: float | None = None,
) -> StreamingQuery:
    """Write one drift row per closed window to ``output``.

    With an ``accuracy`` values are sketched, so that a window keeps a bounded
    number of counters, and rows carry their ``error_bound``; without one they
    are exact.  The stream keeps one counter per (window, value) until the watermark
    passes the window; append mode then hands the whole window to the batch
    test.  Each micro-batch overwrites its own folder, so a replayed batch
    leaves no duplicates.
    """
    # a timestamp without zone cannot carry a watermark
    timed = production.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    if accuracy is not None:
        timed, reference = (side.withColumn(value, value_bucket(column(value), accuracy)) for side in (timed, reference))
    counts = window_value_counts(timed, value, time, size)

    # the reference is laid out once; micro-batches look their values up in it and move none of it
    known = reference_steps(reference, value)
    buckets = reference_counts(reference, value) if accuracy is not None else None

    def test_closed(batch: DataFrame, batch_id: int) -> None:
        # a stream has no end, so each batch clears its own intermediate tables
        with scratch_scope(batch.sparkSession):
            # one evaluation of the stateful plan, whatever the test does with its rows
            closed = materialise(batch, "closed-windows")
            if not closed.isEmpty():
                tests = with_p_value(ks_against_steps(known, closed))
                if buckets is not None:
                    tests = with_error_bound(tests, buckets, closed.filter(F.col("x").isNotNull()))
                tests.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = (
        counts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(test_closed)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
