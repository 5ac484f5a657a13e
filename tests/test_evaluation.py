import math

import random

import pytest

from tidemark.operators import evaluation as E
from tidemark.operators.boosting import best_and_stop
from tidemark.operators.evaluation import alert_lifecycle


def _rounds(spark, losses, run="r"):
    return spark.createDataFrame([(run, i, float(v)) for i, v in enumerate(losses)], "run_id string, step int, value double")


@pytest.mark.parametrize(
    "losses,best,stop",
    [
        ([5, 4, 3, 3, 4, 4, 4, 4, 4, 4, 4, 4, 4, 1], 2, 12),
        ([3, 2, 1], 2, 2),
        ([1] + [2] * 9, 0, 9),
        ([1] + [2] * 30, 0, 10),
        ([1], 0, 0),
    ],
)
def test_early_stop(spark, losses, best, stop):
    row = E.early_stop_round(_rounds(spark, losses)).first()
    assert (row.best_round, row.stop_round) == (best, stop)
    assert best_and_stop(losses, 10) == (best, stop)


def test_log_loss_and_accuracy(spark):
    df = spark.createDataFrame(
        [(0, 0, [0.5, 0.5, 0.0]), (2, 1, [0.25, 0.75, 0.0])], "target int, prediction int, probability array<double>"
    )
    assert E.accuracy(df).first().accuracy == 0.5
    want = -(math.log(0.5) + math.log(1e-15)) / 2
    assert E.log_loss(df).first().log_loss == pytest.approx(want)


def test_losses_leave_out_missing_labels_and_probabilities(spark):
    rows = [(0, [0.5, 0.5], 0.5), (None, [0.5, 0.5], 0.5), (1, None, None), (1, [0.5, float("nan")], float("nan")), (1, [0.75, 0.25], 0.25)]
    df = spark.createDataFrame(rows, "target int, probability array<double>, p double")
    want = -(math.log(0.5) + math.log(0.25)) / 2
    assert E.log_loss(df).first().log_loss == pytest.approx(want)
    assert E.binary_log_loss(df, probability="p").first().log_loss == pytest.approx(want)


def test_missing_accuracy_is_not_registered(spark):
    runs = spark.createDataFrame([(0.6,), (0.5,), (float("nan"),), (None,)], "accuracy double")
    assert [r.decision for r in E.gate_runs(runs).collect()] == ["register"] + ["artifact_only"] * 3


def test_quality_of_a_class_never_predicted(spark):
    predictions = spark.createDataFrame([(i, 0) for i in range(4)], "k int, prediction int")
    truth = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (9, 1)], "k int, y int")
    rows = {r["class"]: r for r in E.quality_from_truth(predictions, truth, "k", "y").collect()}
    assert rows[0].f1 == pytest.approx(0.8) and rows[1].f1 == 0.0 and rows[1].precision == 0.0
    assert rows[0].accuracy == pytest.approx(2 / 3) and rows[0].macro_f1 == pytest.approx(0.4)


def test_alert_rules(spark):
    rows = [("j", "a_p_value", 0.01), ("j", "b_p_value", 0.5), ("j", "a_count", 9.0)]
    gauges = spark.createDataFrame(rows, "job string, metric string, value double")
    hit = E.alerts(gauges, {"_p_value": ("below", 0.05), "_count": ("above", 10)}).collect()
    assert [(r.metric, r.rule) for r in hit] == [("a_p_value", "_p_value below 0.05")]


@pytest.mark.parametrize("hold", [1, 3])
def test_alerts_open_hold_and_resolve(spark, hold):
    rng, rows = random.Random(6), []
    for job, n in (("a", 300), ("b", 20), (None, 15), ("calm", 5)):
        for at in range(n):
            value = rng.choice([1.0, 2.0, 9.0, 8.0, 7.0, None, float("nan")]) if job != "calm" else 1.0
            rows.append((job, "x_p", at, value))
    rows += [("low", "y_q", at, v) for at, v in enumerate([0.5, 0.1, 0.05, 0.2, 0.9, 0.1, 0.1, 0.1])] + [("other", "z", 0, 99.0)]
    history = spark.createDataFrame(rows, "job string, metric string, at int, value double")
    got = {tuple(r) for r in alert_lifecycle(history.repartition(3), {"_p": ("above", 5), "_q": ("below", 0.3)}, hold).collect()}
    want = set()
    for job, metric in {(r[0], r[1]) for r in rows}:
        if metric == "z":
            continue
        rule = "_p above 5" if metric == "x_p" else "_q below 0.3"
        streak = []
        for _, _, at, value in [r for r in rows if (r[0], r[1]) == (job, metric)] + [(job, metric, None, -1.0)]:
            if value is None or value != value:
                continue
            if at is not None and (value > 5 if metric == "x_p" else value < 0.3):
                streak.append((at, value))
                continue
            if len(streak) >= hold:
                worst = (max if metric == "x_p" else min)(v for _, v in streak)
                want.add((job, metric, rule, streak[hold - 1][0], at, len(streak), worst))
            streak = []
    assert got == want and len(want) > 10
