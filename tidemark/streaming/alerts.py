"""Alerts on streams of gauges: opened, held and resolved by state, like ``evaluation.alert_lifecycle`` in batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.functions.columns import column
from tidemark.operators.evaluation import observations
from tidemark.session import timed_state

WATERMARK = "5 minutes"
# observations of an entry of the state
_ENTRY = 10_000
_CHANGE = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("alert", T.LongType()),
        T.StructField("opened_us", T.LongType()),
        T.StructField("ended_us", T.LongType()),
        T.StructField("ended", T.BooleanType()),
        T.StructField("observations", T.LongType()),
        T.StructField("worst", T.DoubleType()),
    ]
)


def _streaks(by: Sequence[str], hold: int) -> StatefulProcessor:
    """The processor of one gauge; its class is made here, so that it travels whole to Spark's workers on the driver, which import no added files."""
    columns = ("at_us", "tie", "value", "past")

    class Streaks(StatefulProcessor):
        """One gauge: its running streak past the limit, and the observations the watermark has not passed yet."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            # next_us: the earliest observation that waits
            self.streak = handle.getValueState("streak", "rule string, alerts long, length long, opened_us long, worst double, next_us long")
            # one entry per batch of rows
            self.waiting = handle.getListState("waiting", "at_us array<long>, tie array<long>, value array<double>, past array<boolean>")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            streak = self.streak.get() if self.streak.exists() else None
            known = earliest = streak[-1] if streak else None
            for frame in rows:
                streak = streak or (frame["rule"].iloc[0], 0, 0, 0, 0.0, None)
                self.waiting.appendValue(tuple(frame[c].tolist() for c in columns))
                here = int(frame["at_us"].min())
                earliest = here if earliest is None else min(earliest, here)
            yield from self._advance(key, (*streak[:-1], earliest), known, timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            yield from self._advance(key, self.streak.get(), None, timerValues.getCurrentWatermarkInMs())

        def _advance(self, key, streak: tuple, timed_us: int | None, watermark_ms: int) -> Iterator[pd.DataFrame]:
            """Take the observations up to the watermark in order; nothing earlier can come after them.

            ``timed_us`` is the observation for which there is a timer.
            """
            rule, alerts, length, opened, worst, next_us = streak
            worse, changes = (max if " above " in rule else min), []
            if next_us is not None and next_us <= 1000 * watermark_ms:
                *due, next_us = self._due(1000 * watermark_ms)
                for at, value, past in zip(*due, strict=True):
                    if past:
                        worst = worse(worst, value) if length else value
                        length += 1
                        if length == hold:
                            alerts, opened = alerts + 1, at
                    else:
                        if length >= hold:
                            changes.append((rule, alerts, opened, at, True, length, worst))
                        length = 0
                if length >= hold:
                    changes.append((rule, alerts, opened, 0, False, length, worst))
            if next_us != timed_us:
                if timed_us is not None:
                    self.handle.deleteTimer(timed_us // 1000 + 1)
                if next_us is not None:
                    self.handle.registerTimer(next_us // 1000 + 1)
            self.streak.update((rule, alerts, length, opened, worst, next_us))
            if changes:
                frame = pd.DataFrame(changes, columns=_CHANGE.names)
                for place, name in enumerate(by):
                    frame.insert(place, name, [key[place]] * len(frame))
                yield frame

        def _due(self, upto_us: int) -> tuple[list, list, list, int | None]:
            """Times, values and marks of the waiting observations up to a time, in order; the later ones go on waiting, from the time at the end."""
            at, tie, value, past = map(np.concatenate, zip(*self.waiting.get(), strict=True))
            order = np.lexsort((past, value, tie, at))
            due, later = np.split(order, [np.searchsorted(at[order], upto_us, side="right")])
            parts = [later[i : i + _ENTRY] for i in range(0, len(later), _ENTRY)]
            if parts:
                self.waiting.put([tuple(c[part].tolist() for c in (at, tie, value, past)) for part in parts])
            else:
                self.waiting.clear()
            return at[due].tolist(), value[due].tolist(), past[due].tolist(), int(at[later[0]]) if parts else None

        def close(self) -> None:
            pass

    return Streaks()


def alert_changes(
    history: DataFrame,
    limits: dict[str, tuple[str, float]],
    hold: int = 1,
    at: str = "at",
    by: Sequence[str] = ("job", "metric"),
    watermark: str = WATERMARK,
) -> DataFrame:
    """What becomes of alerts, from a stream of gauges: a row when one opens, grows or resolves, at most one a micro-batch.

    Columns ``by, rule, alert`` (its number within the gauge), ``opened_at, resolved_at,
    observations, worst``.  Observations are taken in order of ``at`` once the watermark
    has passed them, equal times in the order of the batch form.  The state of a gauge is
    its streak and what the watermark has not passed.
    """
    seen = observations(history, limits)
    tie = F.xxhash64(*map(column, seen.columns))
    timed = seen.withColumns({"_tie": tie, "_at": column(at).cast("timestamp")}).withWatermark("_at", watermark)
    # a missing time has no place in the order
    placed = timed.where("_at IS NOT NULL").select(
        *map(column, by),
        F.col("_rule").alias("rule"),
        F.unix_micros("_at").alias("at_us"),
        F.col("_tie").alias("tie"),
        F.col("value").cast("double").alias("value"),
        F.col("_past").alias("past"),
        "_at",
    )
    schema = T.StructType([*(placed.schema[b] for b in by), *_CHANGE.fields])
    changes = placed.groupBy(*map(column, by)).transformWithStateInPandas(_streaks(by, hold), schema, "Append", "EventTime")
    return changes.select(
        *map(column, by),
        "rule",
        "alert",
        F.timestamp_micros("opened_us").alias("opened_at"),
        F.when(F.col("ended"), F.timestamp_micros("ended_us")).alias("resolved_at"),
        "observations",
        "worst",
    )


def latest_alerts(changes: DataFrame, by: Sequence[str] = ("job", "metric")) -> DataFrame:
    """One row per alert, as the last of its changes has it."""
    state = F.struct("rule", "opened_at", "resolved_at", "observations", "worst")
    newest = F.struct(F.col("resolved_at").isNotNull(), "observations")
    return changes.groupBy(*map(column, by), "alert").agg(F.max_by(state, newest).alias("_state")).select(*map(column, by), "alert", "_state.*")


def alert_stream(
    history: DataFrame,
    limits: dict[str, tuple[str, float]],
    output: str,
    checkpoint: str,
    hold: int = 1,
    at: str = "at",
    by: Sequence[str] = ("job", "metric"),
    watermark: str = WATERMARK,
    available_now: bool = True,
) -> StreamingQuery:
    """Write the changes of every micro-batch to a folder of its own below ``output``, so a replayed one adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    changes = alert_changes(history, limits, hold, at, by, watermark)
    writer = changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with timed_state(history.sparkSession):
        return writer.start()
