"""End-to-end jobs: ingest, training, trading agent, batch scoring, monitoring.

Each job reads tables by path, keeps the rows on the executors and returns a
small summary.  Paths are versioned tables (see ``tidemark.sources.tables``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import drop_incomplete, numeric_names, select_numeric, to_vector
from tidemark.functions.decisions import MINIMUM_ACCURACY
from tidemark.operators.backtest import INITIAL_BALANCE, backtest_path, backtest_summary, transitions
from tidemark.operators.boosting import train_binary, train_multiclass
from tidemark.operators.drift import drift_gauges, drift_test
from tidemark.operators.evaluation import accuracy
from tidemark.operators.features import apply_scaler, encode_labels, fit_scaler, next_direction
from tidemark.operators.qlearning import EPISODES, LinearQ, epsilon_after, epsilon_greedy, fitted_q
from tidemark.operators.scoring import score_batch
from tidemark.operators.splits import chronological_split, random_holdout, sample_exact
from tidemark.session import materialise
from tidemark.sources.metrics import log_metrics, log_params, push_gauges
from tidemark.sources.models import load_model, register_model, save_artifact
from tidemark.sources.series import read_series_csv
from tidemark.sources.tables import overwrite_table, read_table
from tidemark.sources.typed import ingest_typed, labelled_schema

# fixed values of the monitoring job
MONITORING_JOB = "model_monitoring_batch"
SAMPLE_ROWS = 50


def _log_run(
    spark: SparkSession, root: str, params: Mapping[str, object], metrics: Mapping[tuple[str, int | None], float]
) -> str:
    run_id = uuid.uuid4().hex
    log_params(spark, run_id, params, f"{root}/params")
    rows = [(run_id, key, step, float(value), time.time()) for (key, step), value in metrics.items() if value is not None]
    frame = spark.createDataFrame(rows, "run_id string, key string, step bigint, value double, at double")
    log_metrics(frame.withColumn("ts", F.timestamp_seconds("at")).coalesce(1), f"{root}/metrics")
    return run_id


def ingest_labelled(raw: DataFrame, features: Sequence[str], path: str) -> int:
    """Cast ``raw`` to the labelled schema and publish it, replacing the schema."""
    return overwrite_table(ingest_typed(raw, labelled_schema(features)), path, replace_schema=True)


def prepare_series(series: DataFrame, price: str, date: str = "date", ties: Sequence[str] = ()) -> DataFrame:
    """Numeric columns z-scored, next-step direction of the raw price as ``target``, incomplete rows dropped."""
    numeric = select_numeric(series, keep=[date, *ties])
    columns = [c for c in numeric_names(numeric) if c not in (date, *ties)]
    labelled = next_direction(numeric, price, [date, *ties])
    return drop_incomplete(apply_scaler(labelled, fit_scaler(numeric, columns), columns))


def ingest_series(spark: SparkSession, csv_path: str, price: str, path: str, date: str = "date", schema=None) -> int:
    """CSV series to a prepared, published table."""
    return overwrite_table(prepare_series(read_series_csv(spark, csv_path, date, schema), price, date), path, True)


def train_labelled(
    spark: SparkSession,
    path: str,
    root: str,
    name: str,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "target",
    ties: Sequence[str] = (),
    **settings,
) -> dict:
    """Holdout split, multiclass boosting stopped on the test part, accuracy, registration."""
    encoded = encode_labels(read_table(spark, path), label, "_code")
    wanted = dict.fromkeys([*features, *keys, *ties])
    rows = materialise(
        random_holdout(encoded.select(*wanted, "_code"), keys, 0.2, 42, ties), "training"
    )
    train, test = (rows.filter(F.col("split") == part) for part in ("train", "test"))
    model = train_multiclass(train, features, "_code", validation=test, **settings)
    reached = accuracy(model.score(test), "_code").first()["accuracy"]
    version = register_model(model, spark, root, name)
    run = _log_run(
        spark, root, {"data_path": path, "model_type": "one_vs_rest_boosted_trees", "num_class": model.classes, **settings},
        {("accuracy", None): reached, **{("mlogloss", step): loss for step, loss in enumerate(model.losses)}},
    )
    return {"run_id": run, "accuracy": reached, "version": version}


def train_direction(
    spark: SparkSession, path: str, root: str, name: str, date: str = "date", label: str = "target",
    minimum: float = MINIMUM_ACCURACY, **settings,
) -> dict:
    """70/15/15 chronological split, validated boosting, test accuracy, registration behind the gate."""
    table = read_table(spark, path)
    features = [c for c in numeric_names(table) if c not in (date, label)]
    rows = materialise(chronological_split(table, [date]), "training")
    train, validation, test = (rows.filter(F.col("split") == p) for p in ("train", "validation", "test"))
    model = train_binary(train, features, label, validation=validation, **settings)
    reached = accuracy(model.score(test), label).first()["accuracy"]
    version = None
    if reached is not None and reached >= minimum:
        version = register_model(model, spark, root, name)
    else:
        save_artifact(model, spark, f"{root}/artifacts/{uuid.uuid4().hex}")
    run = _log_run(
        spark, root,
        {"model_type": "boosted_trees", "data_split": "70-15-15", "min_accuracy_for_registration": minimum},
        {("test_accuracy", None): reached, ("best_iteration", None): model.rounds - 1},
    )
    return {"run_id": run, "accuracy": reached, "version": version}


def train_agent(
    spark: SparkSession, path: str, root: str, price: str, date: str = "date", label: str = "target",
    episodes: int = EPISODES, iterations: int = EPISODES, initial_balance: float = INITIAL_BALANCE,
    name: str = "agent",
) -> dict:
    """80/20 chronological split, exploring episodes, fitted Q-iteration, greedy back-test, registration.

    Each episode acts on the values fitted to all episodes before it, exploring
    less each time.
    """
    table = read_table(spark, path)
    others = [c for c in numeric_names(table) if c not in (date, label, price)]
    features = [price, *others]
    rows = materialise(
        chronological_split(table.select(date, *features), [date], (0.8,), ("train", "test")), "agent"
    )
    train, test = (rows.filter(F.col("split") == p).drop("split") for p in ("train", "test"))
    stated = train.withColumn("state", to_vector(features)).withColumn("_date_text", F.col(date).cast("string"))
    q, seen, worth = LinearQ(((0.0,) * len(features),) * 3, (0.0,) * 3), None, []
    for episode in range(episodes):
        action = epsilon_greedy(q.values("state"), epsilon_after(F.lit(episode)), ["_episode", "_date_text"])
        walked = materialise(
            stated.withColumn("_episode", F.lit(episode))
            .withColumn("action", action)
            .withColumn("price", F.col(price))
            .drop("state", "_date_text", "_episode"),
            "walked",
        )
        path_taken = backtest_path(walked, [date], (), initial_balance)
        worth.append(backtest_summary(path_taken, [date], (), initial_balance).first()["final_net_worth"])
        steps = materialise(transitions(walked, features, [date], (), initial_balance), "episode")
        seen = steps if seen is None else seen.unionByName(steps)
        q = fitted_q(seen, len(features), iterations)
    acted = (
        test.withColumn("state", to_vector(features))
        .withColumn("action", epsilon_greedy(q.values("state"), 0.0, [date]))
        .withColumn("price", F.col(price))
        .drop("state")
    )
    result = backtest_summary(backtest_path(acted, [date], (), initial_balance), [date], (), initial_balance).first()
    run = _log_run(
        spark, root, {"model_type": "fitted_q"},
        {
            **{("training_net_worth", episode): value for episode, value in enumerate(worth)},
            ("backtest_final_net_worth", None): result["final_net_worth"],
            ("backtest_profit_percentage", None): result["profit_percentage"],
        },
    )
    version = register_model(q, spark, root, name)
    return {"run_id": run, "q": q, "version": version, **result.asDict()}


def score_table(
    spark: SparkSession, path: str, output_path: str, root: str, name: str, stage: str = "Staging",
    output: str = "class",
) -> int:
    """Score the table with the newest model in ``stage`` and publish under an unchanged schema."""
    model = load_model(spark, root, name, stage)
    return overwrite_table(score_batch(read_table(spark, path), model, output), output_path)


def monitor_table(
    spark: SparkSession, path: str, gauges_path: str, features: Sequence[str], keys: Sequence[str],
    ties: Sequence[str] = (), rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Drift between two seeded samples of the table, pushed as gauges of the monitoring job."""
    table = read_table(spark, path).select(*dict.fromkeys([*features, *keys, *ties]))
    reference = sample_exact(table, rows, keys, 42, ties)
    production = sample_exact(table, rows, keys, 1, ties)
    tests = drift_test(reference, production, features)
    push_gauges(drift_gauges(tests, MONITORING_JOB), gauges_path)
    return tests
