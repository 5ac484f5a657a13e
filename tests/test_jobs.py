"""End-to-end runs of the jobs on small made tables."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.boosting import best_and_stop, train_binary
from tidemark.operators.scoring import ForeignModel, score_batch, score_requests
from tidemark.plans import jobs
from tidemark.session import scratch_root
from tidemark.sources.metrics import read_gauges, read_metrics, read_params
from tidemark.sources.models import ModelNotFound, load_model, read_events, register_model, transition_stage
from tidemark.sources.tables import SchemaMismatch, overwrite_table, read_table
from tidemark.streaming.drift import drift_stream
from tidemark.streaming.scoring import read_request_stream, score_stream

FEATURES = ["sl", "sw", "pl", "pw"]


@pytest.fixture(scope="module")
def flowers(spark, tmp_path_factory):
    """Three well separated classes, published as a labelled table."""
    rng = random.Random(0)
    rows = [
        (*(c * 2 + rng.random() for _ in range(4)), c, f"class{c}") for c in range(3) for _ in range(60)
    ]
    path = str(tmp_path_factory.mktemp("flowers"))
    raw = spark.createDataFrame(rows, "sl double, sw double, pl double, pw double, target int, target_name string")
    jobs.ingest_labelled(raw, FEATURES, path)
    return path


def test_ingest_train_promote_score(spark, flowers, tmp_path):
    root, out = str(tmp_path / "models"), str(tmp_path / "predictions")
    result = jobs.train_labelled(spark, flowers, root, "flowers", FEATURES, ["sl", "sw"], max_rounds=5)
    assert result["version"] == 1 and result["accuracy"] > 0.9
    with pytest.raises(ModelNotFound):
        jobs.score_table(spark, flowers, out, root, "flowers", "Staging")
    transition_stage(spark, root, "flowers", 1, "Staging")
    jobs.score_table(spark, flowers, out, root, "flowers", "Staging")
    predictions = read_table(spark, out)
    assert predictions.count() == 180 and "prediction" in predictions.columns
    assert predictions.filter(F.col("prediction") != F.col("target")).count() < 18
    # every probability vector covers the three classes and sums to one
    sums = predictions.select(F.aggregate("probability", F.lit(0.0), lambda a, v: a + v).alias("s"), F.size("probability").alias("n"))
    assert sums.filter((F.abs(F.col("s") - 1) > 1e-9) | (F.col("n") != 3)).count() == 0
    model = load_model(spark, root, "flowers", "Staging")
    leftmost = score_batch(read_table(spark, flowers), model, "leftmost_probability")
    assert leftmost.filter(F.col("prediction") != F.col("probability")[0]).count() == 0
    # an unchanged schema may be overwritten, a changed one may not
    jobs.score_table(spark, flowers, out, root, "flowers", "Staging")
    with pytest.raises(SchemaMismatch):
        overwrite_table(predictions.drop("prediction"), out)
    assert read_metrics(spark, f"{root}/metrics").filter("key = 'accuracy'").count() == 1
    assert read_params(spark, f"{root}/params").filter("key = 'data_path'").first().value == flowers


def _series_csv(tmp_path, n=120):
    rng = random.Random(4)
    lines = ["date,close,SP,note"]
    for i in range(n):
        lines.append(f"2024-{1 + i // 28:02d}-{1 + i % 28:02d},{rng.gauss(0, 1):.6f},{rng.gauss(0, 1):.6f},x")
    file = tmp_path / "series.csv"
    file.write_text("\n".join([lines[0], *reversed(lines[1:])]))
    return str(file)


def test_series_experiment(spark, tmp_path):
    path, root = str(tmp_path / "series"), str(tmp_path / "runs")
    jobs.ingest_series(spark, _series_csv(tmp_path), "close", path)
    table = read_table(spark, path)
    assert table.columns == ["date", "close", "SP", "target"] and table.count() == 120
    kept = jobs.train_direction(spark, path, root, "direction", max_rounds=3, minimum=0.0)
    assert kept["version"] == 1
    gated = jobs.train_direction(spark, path, root, "direction", max_rounds=3, minimum=1.01)
    assert gated["version"] is None and read_events(spark, root).count() == 1
    agent = jobs.train_agent(spark, path, root, "close", episodes=2, iterations=2)
    assert agent["total_profit"] == pytest.approx(agent["final_net_worth"] - 10_000)
    keys = {r.key for r in read_metrics(spark, f"{root}/metrics").select("key").distinct().collect()}
    assert {"test_accuracy", "best_iteration", "training_net_worth", "backtest_final_net_worth"} <= keys
    assert agent["version"] == 1
    transition_stage(spark, root, "agent", 1, "Production")
    assert load_model(spark, root, "agent", "Production") == agent["q"]


def test_training_stops_before_its_last_round_and_is_cut(spark):
    rng = random.Random(1)
    rows = [(i, float(i % 50), int((i % 50 > 24) != (rng.random() < 0.3))) for i in range(1200)]
    df = spark.createDataFrame(rows, "i int, `x.1` double, target int")
    model = train_binary(df.where("i < 800"), ["x.1"], validation=df.where("i >= 800"), patience=3, max_rounds=60)
    losses = model.losses
    assert len(losses) < 60 and model.rounds == best_and_stop(losses, 3)[0] + 1
    scored = model.score(df)
    assert scored.columns == ["i", "x.1", "target", "probability", "prediction"]
    assert scored.where(F.col("prediction") == (F.col("`x.1`") > 24).cast("int")).count() > 1100


def test_any_model_is_registered(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    root, df = str(tmp_path / "models"), spark.createDataFrame([(1.0, 2.0)], "l_quantity double, l_extendedprice double")
    plain = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity"], outputCol="v")]).fit(df)
    foreign = ForeignModel(("l_quantity", "l_extendedprice"), "tidemark.plans.queries_models:linear_model", {"by_quantity": 1.0, "by_price": -1.0})
    for name, model in (("plain", plain), ("foreign", foreign)):
        version = register_model(model, spark, root, name)
        transition_stage(spark, root, name, version, "Staging")
    assert score_batch(df, load_model(spark, root, "plain", "Staging")).columns[-1] == "v"
    loaded = load_model(spark, root, "foreign", "Staging")
    assert loaded == foreign and score_batch(df, loaded).first().prediction == 0.0
    bad = ForeignModel(("k",), "tests.test_jobs:nothing_usable")
    bodies = spark.createDataFrame([('{"k": 1}',), ("no",)], "body string")
    assert {r.status for r in score_requests(bodies, ["k"], bad).collect()} == {"scoring_error", "invalid"}


def nothing_usable():
    import numpy as np

    return lambda rows: np.full((len(rows), 2), np.nan)


def test_monitoring_pushes_two_gauges_per_feature(spark, flowers, tmp_path):
    path = str(tmp_path / "gauges")
    jobs.monitor_table(spark, flowers, path, ["sl"], FEATURES)
    rows = read_gauges(spark, path).filter(F.col("job") == jobs.MONITORING_JOB).collect()
    assert {r.metric for r in rows} == {"sl_ks_statistic", "sl_p_value"}


@pytest.fixture(scope="module")
def threshold_model(spark):
    rows = spark.range(200).select(F.col("id").cast("double").alias("k"), (F.col("id") >= 100).cast("int").alias("target"))
    return train_binary(rows, ["k"], max_rounds=2)


def test_requests_in_batch_and_stream_agree(spark, threshold_model, tmp_path):
    bodies = ['{"k": 5}', '{"k": 150}', '{"other": 1}', "nope"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    batch = {(r.id, r.k, r.status, r.prediction) for r in score_requests(df, ["k"], threshold_model).collect()}
    assert batch == {(0, 5.0, "ok", 0), (1, 150.0, "ok", 1), (2, None, "invalid", None), (3, None, "invalid", None)}
    without = {r.status for r in score_requests(df, ["k"], None).collect()}
    assert without == {"no_model", "invalid"}
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df.write.parquet(source)
    for _ in range(2):  # a restart from the checkpoint adds nothing
        stream = read_request_stream(spark, source, df.schema)
        score_stream(stream, ["k"], threshold_model, out, state).awaitTermination()
    got = {(r.id, r.k, r.status, r.prediction) for r in spark.read.parquet(out).collect()}
    assert got == batch


def _scratch_tables(spark):
    from pathlib import Path

    return {p.name for p in Path(scratch_root(spark)).iterdir()}


def test_drift_stream_emits_closed_windows_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.range(4 * 60).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"), (F.col("id") % 10).cast("double").alias("v")
    )
    for hour in range(4):
        part = rows.filter((F.minute("ts") >= 0) & (F.hour("ts") == hour))
        part.coalesce(1).write.mode("append").parquet(source)
    reference = spark.range(10).select(F.col("id").cast("double").alias("v"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    before = _scratch_tables(spark)
    drift_stream(stream, reference, "v", "ts", out, state).awaitTermination()
    # only the reference's table is left, however many batches there were
    assert [t for t in _scratch_tables(spark) - before if not t.startswith("reference-steps")] == []
    got = spark.read.parquet(f"{out}/batch=*").orderBy("window_start").collect()
    # the last window starts at 03:45 and is still open; the watermark reached 03:44
    assert len(got) == 14 and {r.n2 for r in got} == {15}
    # fifteen minutes hold half of the ten values twice: 10/15 - 5/10
    assert all(r.statistic == pytest.approx(1 / 6) for r in got)
