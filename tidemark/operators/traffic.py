"""Request metrics over a request log, and drift-free trailing rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import Running, lay_out

RATE_SECONDS = 300
# time is cut into blocks of this length; a window over one block sees at most
# BLOCK_SECONDS + RATE_SECONDS rows, one per second
BLOCK_SECONDS = 3_600


def request_totals(log: DataFrame, by: str) -> DataFrame:
    return log.groupBy(by).agg(F.count(F.lit(1)).alias("requests"))


def latency_histogram(log: DataFrame, by: str, latency: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative ``le`` buckets, with ``+Inf`` last; one row per (type, bucket)."""
    counted = log.groupBy(by).agg(
        *[F.count_if(F.col(latency) <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)],
        F.count(latency).alias("le_inf"),
    )
    buckets = F.array(
        *[
            F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"le_{i}").alias("requests"))
            for i, b in enumerate(bounds)
        ],
        F.struct(F.lit("+Inf").alias("le"), F.col("le_inf").alias("requests")),
    )
    return counted.select(by, F.inline(buckets))


def in_progress(log: DataFrame, by: str, start: str, end: str) -> DataFrame:
    """``by, at, in_progress``: open requests after all starts and ends at each instant.

    A request counts from its start up to, but not at, its end.
    """
    changes = F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).cast("bigint").alias("change")),
        F.struct(F.col(end).alias("at"), F.lit(-1).cast("bigint").alias("change")),
    )
    per_instant = (
        log.select(by, F.inline(changes))
        .filter(F.col("at").isNotNull())
        .groupBy(by, "at")
        .agg(F.sum("change").alias("change"))
    )
    running = lay_out(per_instant, ["at"], by=[by]).with_running(in_progress=Running("sum", F.col("change")))
    return running.rows().drop("change")


def trailing_rate(log: DataFrame, by: str, epoch: str, seconds: int = RATE_SECONDS) -> DataFrame:
    """Requests in the last ``seconds`` and their rate, at every second with a request.

    Rows are first counted per second.  Each second goes to its time block and
    to the following block when it can still be seen from there, so a busy type is
    spread over blocks whose size the calendar bounds.
    """
    per_second = log.groupBy(by, F.col(epoch).alias("epoch_s")).agg(F.count(F.lit(1)).alias("n"))
    span = max(BLOCK_SECONDS, seconds)
    home = F.floor(F.col("epoch_s") / span)
    placed = per_second.withColumn("_home", home).withColumn(
        "_block",
        F.explode(
            F.when(
                F.floor((F.col("epoch_s") + (seconds - 1)) / span) > F.col("_home"),
                F.array("_home", F.col("_home") + 1),
            ).otherwise(F.array("_home"))
        ),
    )
    window = Window.partitionBy(by, "_block").orderBy("epoch_s").rangeBetween(-(seconds - 1), 0)
    return (
        placed.withColumn("trailing", F.sum("n").over(window))
        .filter(F.col("_block") == F.col("_home"))
        .select(by, "epoch_s", "trailing", (F.col("trailing") / F.lit(float(seconds))).alias("rate"))
    )
