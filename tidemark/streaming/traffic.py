"""Request gauges on streams: open requests and latency buckets from starts and ends that arrive apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.session import timed_state
from tidemark.sources.metrics import push_gauges

START, END = "start", "end"
# a request that has not ended after this many seconds is given up
TIMEOUT = 3_600
WATERMARK = "1 minute"
# requests are held in so many groups: a call of the processor for each request would cost more than its work
SLOTS = 1024
_CHANGE = "kind string, opened long, ended long, expired long, latency double"


def _requests(timeout: int) -> StatefulProcessor:
    """The processor of a slot of requests; its class is made here, so that it travels whole to Spark's workers on the driver, which import no added files."""
    timeout_ms, start_event, names = 1000 * timeout, START, [c.split()[0] for c in _CHANGE.split(", ")]

    class Requests(StatefulProcessor):
        """One slot: what is known of its requests' starts and ends and when they run out, in milliseconds; -1 for unknown."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.known = handle.getValueState(
                "known", "id array<string>, kind array<string>, start_ms array<long>, end_ms array<long>, due_ms array<long>, alarm_ms long"
            )

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            known, alarm = self._load()
            was_open: dict[str | None, bool] = {}
            for frame in rows:
                for request, event, kind, at in zip(*(frame[c].tolist() for c in ("request_id", "event", "kind", "at_ms")), strict=True):
                    _, start, end, due = known.get(request, (None, -1, -1, -1))
                    was_open.setdefault(request, start >= 0)
                    if event == start_event:
                        start = at if start < 0 else min(start, at)
                    else:
                        end = at if end < 0 else min(end, at)
                    known[request] = (kind, start, end, due)
            changes = []
            for request, opened_before in was_open.items():
                kind, start, end, _ = known[request]
                if start >= 0 and end >= 0:
                    del known[request]
                    changes.append((kind, int(not opened_before), 1, 0, (end - start) / 1000.0))
                elif start >= 0 and not opened_before:
                    known[request] = (kind, start, end, start + timeout_ms)
                    changes.append((kind, 1, 0, 0, None))
            self._keep(known, alarm)
            yield from self._frames(changes)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            known, _ = self._load()
            passed = timerValues.getCurrentWatermarkInMs()
            over = [request for request, (_, _, _, due) in known.items() if 0 <= due <= passed]
            changes = [(known.pop(request)[0], 0, 0, 1, None) for request in over]
            self._keep(known, -1)
            yield from self._frames(changes)

        def _load(self) -> tuple[dict, int]:
            if not self.known.exists():
                return {}, -1
            ids, *columns, alarm = self.known.get()
            return dict(zip(ids, zip(*columns, strict=True), strict=True)), alarm

        def _keep(self, known: dict, alarm: int) -> None:
            """Store what is known, with one timer for the request that runs out first."""
            first = min((due for _, _, _, due in known.values() if due >= 0), default=-1)
            if first != alarm:
                if alarm >= 0:
                    self.handle.deleteTimer(alarm)
                if first >= 0:
                    self.handle.registerTimer(first)
            if known:
                self.known.update((list(known), *map(list, zip(*known.values(), strict=True)), first))
            else:
                self.known.clear()

        @staticmethod
        def _frames(changes: list) -> Iterator[pd.DataFrame]:
            if changes:
                yield pd.DataFrame(changes, columns=names).astype({"latency": float})

        def close(self) -> None:
            pass

    return Requests()


def request_changes(
    events: DataFrame, request_id: str, event: str, kind: str, at: str, timeout: int = TIMEOUT, watermark: str = WATERMARK, slots: int = SLOTS
) -> DataFrame:
    """Openings, ends and expiries of requests, from a stream of their start and end events.

    State is what is known of the open requests, one row per slot of requests, and a
    request leaves it when it ends or runs out of time; an end that comes before its
    start waits for it.  More ``slots`` are smaller ones; a checkpoint keeps to its number.
    """
    timed = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", watermark)
    request = F.col(request_id).cast("string")
    named = timed.select(
        F.pmod(F.xxhash64(request), F.lit(slots)).alias("slot"),
        request.alias("request_id"),
        F.col(event).alias("event"),
        F.col(kind).alias("kind"),
        F.unix_millis("_at").alias("at_ms"),
        "_at",
    )
    return named.groupBy("slot").transformWithStateInPandas(_requests(timeout), _CHANGE, "Append", "EventTime")


def change_counts(changes: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Per kind: requests opened, ended and expired, and those ended within each bound."""
    return changes.groupBy("kind").agg(
        *[F.sum(c).alias(c) for c in ("opened", "ended", "expired")],
        *[F.count_if(F.col("latency") <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)],
    )


def gauges(counts: DataFrame, bounds: Sequence[float], job: str) -> DataFrame:
    """Gauges of all counts so far: requests in progress, total, expired, and cumulative latency buckets per kind."""
    summed = counts.groupBy("kind").agg(*[F.sum(c).alias(c) for c in counts.columns if c != "kind"])
    values = {
        "in_progress": F.col("opened") - F.col("ended") - F.col("expired"),
        "requests_total": F.col("opened"),
        "expired_total": F.col("expired"),
        **{f"latency_le_{b:g}": F.col(f"le_{i}") for i, b in enumerate(bounds)},
        "latency_le_inf": F.col("ended"),
    }
    pairs = F.array(*[F.struct(F.concat_ws("_", "kind", F.lit(n)).alias("metric"), v.cast("double").alias("value")) for n, v in values.items()])
    return summed.select(F.lit(job).alias("job"), F.inline(pairs))


def gauge_stream(
    events: DataFrame,
    request_id: str,
    event: str,
    kind: str,
    at: str,
    bounds: Sequence[float],
    job: str,
    counts_path: str,
    gauges_path: str,
    checkpoint: str,
    timeout: int = TIMEOUT,
    watermark: str = WATERMARK,
    available_now: bool = True,
) -> StreamingQuery:
    """Push the job's gauges after every micro-batch.

    Each micro-batch writes its counts to its own folder, so a replayed one
    counts once, and the gauges are those of all folders.
    """
    schema = ", ".join(["kind string", *(f"{c} long" for c in ("opened", "ended", "expired", *(f"le_{i}" for i in range(len(bounds)))))])

    def push(batch: DataFrame, batch_id: int) -> None:
        change_counts(batch, bounds).coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/batch={batch_id}")
        known = batch.sparkSession.read.schema(schema).parquet(f"{counts_path}/batch=*")
        push_gauges(gauges(known, bounds, job), gauges_path)

    changes = request_changes(events, request_id, event, kind, at, timeout, watermark)
    writer = changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(push)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with timed_state(events.sparkSession):
        return writer.start()
