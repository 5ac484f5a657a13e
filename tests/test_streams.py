"""Streams against their batch forms: drift lookups, late truth, live promotion."""

import bisect
import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.drift import ks_against_counts, ks_against_steps, locate, reference_counts, reference_steps
from tidemark.operators.evaluation import alert_lifecycle
from tidemark.operators.scoring import ForeignModel
from tidemark.sources.metrics import read_gauges
from tidemark.sources.models import register_model, transition_stage
from tidemark.streaming.alerts import alert_stream, latest_alerts
from tidemark.streaming.drift import drift_stream
from tidemark.streaming.quality import quality_by_window, quality_counts, quality_stream, with_truth
from tidemark.streaming.scoring import score_stream_by_stage
from tidemark.streaming.traffic import gauge_stream


@pytest.fixture(scope="module")
def reference(spark):
    rng = random.Random(1)
    values = [round(rng.gauss(0, 1), 2) for _ in range(3000)] + [None, float("nan")]
    return spark.createDataFrame([(v,) for v in values], "v double"), [v for v in values if v is not None and v == v]


def test_located_values_are_ranks(spark, reference):
    frame, values = reference
    steps = reference_steps(frame, "v")
    assert steps.rows == 3000 and len(steps.bounds) > 1
    rng, ordered = random.Random(2), sorted(values)
    wanted = [*(rng.uniform(-5, 5) for _ in range(200)), *rng.sample(values, 100), float("-inf"), float("inf"), ordered[0], ordered[-1], -0.0]
    counts = spark.createDataFrame([("w", x, 1) for x in wanted], "window_start string, x double, c2 long")
    got = locate(steps, counts).collect()
    assert len(got) == len(wanted)
    for r in got:
        assert (r["upto"], r["below"]) == (bisect.bisect_right(ordered, r["x"]), bisect.bisect_left(ordered, r["x"]))


def test_the_reference_is_not_moved(spark, reference):
    steps = reference_steps(reference[0], "v")
    counts = spark.createDataFrame([("w", 0.5, 1)], "window_start string, x double, c2 long")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        locate(steps, counts).explain("simple")
    plan = shown.getvalue().split("Initial Plan")[0]
    # only the wanted values are shuffled to the buckets
    assert plan.count("Exchange") == 1 and plan.count("Scan parquet") == 1
    assert plan.index("Exchange") < plan.index("Scan parquet")


def test_steps_and_counts_agree(spark, reference):
    frame, _ = reference
    rng = random.Random(3)
    rows = [(f"w{i % 5}", rng.choice([rng.gauss(i % 5, 1), 0.25, float("nan"), None]), 1 + i % 3) for i in range(400)]
    counts = spark.createDataFrame(rows, "window_start string, x double, c2 long").groupBy("window_start", "x").agg(F.sum("c2").alias("c2"))
    one = {r["window_start"]: tuple(r)[1:] for r in ks_against_steps(reference_steps(frame, "v"), counts).collect()}
    two = {r["window_start"]: tuple(r)[1:] for r in ks_against_counts(reference_counts(frame, "v"), counts).collect()}
    assert one.keys() == two.keys()
    for key in one:
        assert one[key] == pytest.approx(two[key])


def test_an_empty_reference_has_no_statistic(spark, reference):
    counts = spark.createDataFrame([("w", 0.5, 1), ("w", 1.5, 2)], "window_start string, x double, c2 long")
    got = ks_against_steps(reference_steps(reference[0].limit(0), "v"), counts).collect()
    assert [(r["n1"], r["n2"], r["statistic"]) for r in got] == [(0, 3, None)]


def test_late_truth_on_a_stream_equals_the_batch(spark, tmp_path):
    base = 1_704_067_200
    rows = [(i, base + i * 120, i % 2, (i * 7 % 100) * 60 if i % 5 else None, i % 3 == 0) for i in range(200)]
    frame = spark.createDataFrame(rows, "id int, at long, prediction int, wait int, up boolean")
    predictions = frame.select("id", F.timestamp_seconds("at").alias("at"), "prediction")
    truth = frame.where("wait is not null").select("id", F.timestamp_seconds(F.col("at") + F.col("wait")).alias("known"), F.col("up").cast("int").alias("label"))
    want = {tuple(r) for r in quality_by_window(quality_counts(with_truth(predictions, truth, "id", "label", "at", "known"), "label", "at"), "label").collect()}
    streams = []
    for name, part, time in (("p", predictions, "at"), ("t", truth, "known")):
        for half in range(2):
            cut = F.timestamp_seconds(F.lit(base + 100 * 120))
            part.where((F.col(time) >= cut) == F.lit(bool(half))).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        last = part.limit(1).withColumn(time, F.timestamp_seconds(F.lit(base + 10**6))).withColumn("id", F.lit(-1))
        last.select(part.columns).write.mode("append").parquet(str(tmp_path / name))
        streams.append(spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # a restart adds nothing
        quality_stream(*streams, "id", "label", "at", "known", out, state).awaitTermination()
    counts = spark.read.parquet(out).where(F.col("window_start") < F.timestamp_seconds(F.lit(base + 10**5)))
    assert {tuple(r) for r in quality_by_window(counts, "label").collect()} == want
    assert sum(r[1] for r in want) == 200 and sum(r[2] for r in want) > 40


def sign(up):
    import numpy as np

    def predict(rows):
        positive = (rows[:, 0] * up > 0).astype(float)
        return np.stack([1 - positive, positive], axis=1)

    return predict


def test_a_promotion_changes_later_rows_only(spark, tmp_path):
    root, source, out, state = (str(tmp_path / n) for n in ("models", "in", "out", "state"))
    schema = "id int, body string"
    spark.createDataFrame([], schema).write.parquet(source)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        score_stream_by_stage(stream, ["k"], root, "m", "Production", out, state).awaitTermination()

    run([(0, '{"k": 1}')])
    first = register_model(ForeignModel(("k",), "tests.test_streams:sign", {"up": 1}), spark, root, "m")
    transition_stage(spark, root, "m", first, "Production")
    run([(1, '{"k": 1}'), (2, "no")])
    second = register_model(ForeignModel(("k",), "tests.test_streams:sign", {"up": -1}), spark, root, "m")
    run([(3, '{"k": 1}')])
    transition_stage(spark, root, "m", second, "Production")
    run([(4, '{"k": 1}')])
    run([])
    schema_out = "id int, body string, k double, status string, prediction int, model_version long"
    got = {(r["id"], r["status"], r["prediction"], r["model_version"]) for r in spark.read.schema(schema_out).parquet(f"{out}/batch=*").collect()}
    assert got == {(0, "no_model", None, None), (1, "ok", 1, 1), (2, "invalid", None, 1), (3, "ok", 1, 1), (4, "ok", 0, 2)}
    # a batch that is replayed writes its folder again
    before = spark.read.schema(schema_out).parquet(f"{out}/batch=*").count()
    import shutil

    shutil.copytree(state, str(tmp_path / "older"), ignore=lambda d, names: [n for n in names if d.endswith("commits") and n.lstrip(".").startswith("3")])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    score_stream_by_stage(stream, ["k"], root, "m", "Production", out, str(tmp_path / "older")).awaitTermination()
    assert spark.read.schema(schema_out).parquet(f"{out}/batch=*").count() == before


def test_open_requests_end_expire_and_wait_for_their_start(spark, tmp_path):
    schema = "id int, event string, kind string, at long"
    batches = [
        [(1, "start", "a", 0), (2, "start", "a", 10), (3, "start", "b", 20), (4, "start", "b", 30), (4, "end", "b", 45)],
        [(1, "end", "a", 60), (5, "end", "a", 70), (6, "start", "a", 80)],
        [(5, "start", "a", 65), (7, "start", "b", 500), (3, "end", "b", 501)],
    ]
    source, counts, path, state = (str(tmp_path / n) for n in ("in", "counts", "gauges", "state"))
    seen = []
    for rows in batches:
        frame = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        gauge_stream(stream, "id", "event", "kind", "at", [20, 100], "r", counts, path, state, timeout=300).awaitTermination()
        seen.append({r["metric"]: r["value"] for r in read_gauges(spark, path).collect()})
    assert (seen[0]["a_in_progress"], seen[0]["b_in_progress"], seen[0]["b_latency_le_20"]) == (2, 1, 1)
    assert (seen[1]["a_in_progress"], seen[1]["a_latency_le_20"], seen[1]["a_latency_le_100"]) == (2, 0, 1)
    # the late start of 5 meets its end; 2 and 6 have run out of time once the clock has passed 300 seconds more
    assert (seen[2]["a_requests_total"], seen[2]["a_latency_le_20"], seen[2]["a_expired_total"], seen[2]["a_in_progress"]) == (4, 1, 2, 0)
    assert seen[2]["b_requests_total"] == 3 and seen[2]["b_in_progress"] + seen[2]["b_expired_total"] + seen[2]["b_latency_le_inf"] == 3


def test_a_sketched_stream_bounds_its_error(spark, tmp_path):
    rng = random.Random(5)
    rows = [(1_704_067_200 + i * 10, rng.gauss(i // 90 % 2, 1)) for i in range(720)]
    frame = spark.createDataFrame(rows, "at long, v double").select(F.timestamp_seconds("at").alias("ts"), "v")
    source, reference = str(tmp_path / "in"), [rng.gauss(0, 1) for _ in range(500)]
    for half in range(2):
        frame.where((F.col("ts") >= F.timestamp_seconds(F.lit(rows[360][0]))) == F.lit(bool(half))).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
    known, out = spark.createDataFrame([(v,) for v in reference], "v double"), str(tmp_path / "out")
    drift_stream(stream, known, "v", "ts", out, str(tmp_path / "state"), accuracy=0.01).awaitTermination()
    got = spark.read.parquet(f"{out}/batch=*").withColumn("at", F.unix_seconds("window_start")).collect()
    assert len(got) >= 6
    for row in got:
        mine = sorted(v for at, v in rows if row["at"] <= at < row["at"] + 900)
        points = sorted([*mine, *reference])
        other = sorted(reference)
        exact = max(abs(bisect.bisect_right(mine, x) / len(mine) - bisect.bisect_right(other, x) / len(other)) for x in points)
        assert row["statistic"] - 1e-9 <= exact <= row["statistic"] + row["error_bound"] + 1e-9 and row["error_bound"] < 0.1


@pytest.mark.parametrize("hold", [1, 3])
def test_streamed_alerts_equal_the_batch(spark, tmp_path, hold):
    """Equal times, missing values and keys, disorder within the watermark, a restart: the alerts of the batch form."""
    rng, rows = random.Random(7), []
    for job, metric, n in (("a", "x_p", 240), (None, "x_p", 60), ("b", "y_q", 60), ("other", "z", 9)):
        for i in range(n):
            value = rng.choice([0.1, 0.2, 0.9, 7.0, 8.0, 9.0, None, float("nan")])
            rows.append((job, metric, 1_700_000_000 + 30 * (i // 2), value, i))
    schema = "job string, metric string, at long, value double, note int"
    frame = spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("at"))
    limits = {"_p": ("above", 5), "_q": ("below", 0.3)}
    want = {tuple(r) for r in alert_lifecycle(frame, limits, hold).select("job", "metric", "rule", "opened_at", "resolved_at", "observations", "worst").collect()}
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    jitter = 60 * 3
    parts = [[], [], []]
    for row in rows:
        parts[min(2, max(0, (row[2] + rng.randint(-jitter, jitter) - 1_700_000_000) // 1200))].append(row)
    parts.append([("b", "z_q", 1_700_100_000, 9.0, 0)])
    for number, part in enumerate(parts):
        rng.shuffle(part)
        arrived = spark.createDataFrame(part, schema).withColumn("at", F.timestamp_seconds("at"))
        arrived.coalesce(1).write.mode("append").parquet(source)
        if number in (1, 3):  # two files in one run, then a restart with the others
            stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
            alert_stream(stream, limits, out, state, hold, watermark="10 minutes").awaitTermination()
    changes = spark.read.parquet(f"{out}/batch=*")
    latest = latest_alerts(changes).select("job", "metric", "rule", "opened_at", "resolved_at", "observations", "worst")
    assert {tuple(r) for r in latest.collect()} == want and len(want) > 8
    # an alert that outlives a micro-batch is told of more than once
    assert changes.count() >= len(want)
