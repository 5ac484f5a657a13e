"""Streams with several states per key, in a session as others set it up."""

import os
import subprocess
import sys

import pytest
from pyspark.cloudpickle import dumps
from pyspark.sql import functions as F

from tests import test_streams
from tidemark.sources.metrics import read_gauges
from tidemark.streaming import alerts, traffic

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture
def default_store(spark):
    """Spark's own state store, which holds one state per key; the session keeps it."""
    given = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, DEFAULT)
    yield spark
    kept = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, given)
    assert kept == DEFAULT


def loads_alone(processor):
    """Whether the processor can be read where this repository cannot be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", "import pickle, sys; pickle.load(sys.stdin.buffer)"], input=dumps(processor), cwd="/", env=env).returncode == 0


def test_alerts_run_on_the_default_state_store(default_store, tmp_path):
    spark = default_store
    values = [9.0, 9.5, 8.0, 1.0, 7.0, 2.0]
    rows = [("a", "x_p", 1_700_000_000 + 60 * i, v) for i, v in enumerate(values)] + [("end", "end_p", 1_700_100_000, 0.0)]
    frame = spark.createDataFrame(rows, "job string, metric string, at long, value double").withColumn("at", F.timestamp_seconds("at"))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    frame.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    alerts.alert_stream(stream, {"_p": ("above", 5)}, out, state, hold=2).awaitTermination()
    latest = alerts.latest_alerts(spark.read.parquet(f"{out}/batch=*")).select(F.unix_seconds("opened_at"), F.unix_seconds("resolved_at"), "observations", "worst")
    assert [tuple(r) for r in latest.collect()] == [(1_700_000_060, 1_700_000_180, 3, 9.5)]


def test_the_processor_of_alerts_needs_no_import():
    assert loads_alone(alerts._streaks(["job"], 2))


def push(spark, tmp_path, rows, timeout=300):
    """The gauges after one more file of requests."""
    source, counts, path, state = (str(tmp_path / n) for n in ("in", "counts", "gauges", "state"))
    frame = spark.createDataFrame(rows, "id int, event string, kind string, at long").withColumn("at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
    frame.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    traffic.gauge_stream(stream, "id", "event", "kind", "at", [20], "r", counts, path, state, timeout=timeout).awaitTermination()
    return {r["metric"]: r["value"] for r in read_gauges(spark, path).collect()}


def test_request_gauges_run_on_the_default_state_store(default_store, tmp_path):
    assert push(default_store, tmp_path, [(1, "start", "a", 0), (2, "start", "a", 5), (1, "end", "a", 15)]) == {
        "a_in_progress": 1, "a_requests_total": 2, "a_expired_total": 0, "a_latency_le_20": 1, "a_latency_le_inf": 1
    }


def test_the_processor_of_requests_needs_no_import():
    assert loads_alone(traffic._requests(300))


def test_many_requests_of_a_slot(spark, tmp_path):
    """Requests that share slots open, end, meet early ends and expire each for itself."""
    n = 3 * traffic.SLOTS
    first = [(i, "start", "a", i % 50) for i in range(n)] + [(n + i, "end", "b", 40) for i in range(n)]
    got = push(spark, tmp_path, first)
    assert (got["a_in_progress"], got["a_requests_total"]) == (n, n) and "b_in_progress" not in got
    # every third ends; the early ends get every second start; the clock passes the end of those that started up to 21
    second = [(i, "end", "a", i % 50 + 19 + i % 2) for i in range(0, n, 3)] + [(n + i, "start", "b", 30) for i in range(0, n, 2)] + [(-1, "start", "c", 381)]
    got = push(spark, tmp_path, second)
    over = sum(i % 3 > 0 and i % 50 <= 21 for i in range(n))
    assert (got["a_latency_le_20"], got["a_expired_total"], got["a_in_progress"]) == (n / 3, over, n - n / 3 - over)
    assert (got["b_requests_total"], got["b_latency_le_20"], got["b_in_progress"]) == (n / 2, n / 2, 0)
    # the others expire as the clock goes on
    got = push(spark, tmp_path, [(-2, "start", "c", 2_000)])
    assert (got["a_expired_total"], got["a_in_progress"], got["c_in_progress"]) == (n - n / 3, 0, 1)


@pytest.mark.parametrize("hold", [1, 3])
def test_alerts_wait_in_several_entries(spark, tmp_path, monkeypatch, hold):
    """Small batches and entries of the state: the alerts of the batch form all the same."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = spark.conf.get(key)
    monkeypatch.setattr(alerts, "_ENTRY", 3)
    spark.conf.set(key, 7)
    try:
        test_streams.test_streamed_alerts_equal_the_batch(spark, tmp_path, hold)
    finally:
        spark.conf.set(key, given)
