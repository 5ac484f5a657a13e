"""Staged margins, joint stopping and missing values of boosted trees."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.boosting import best_and_stop, train_binary, train_multiclass
from tidemark.operators.evaluation import staged_log_loss
from tidemark.sources.models import load_artifact, save_artifact


@pytest.fixture(scope="module")
def noisy(spark):
    rng, rows = random.Random(3), []
    for i in range(900):
        x, y = rng.random(), rng.random()
        label = int(3 * x) if rng.random() < 0.8 else rng.randrange(3)
        rows.append((i, x, y, label, "x"))
    table = spark.createDataFrame(rows, "i int, `a.b` double, y double, target int, margins string")
    return table.where("i < 600"), table.where("i >= 600")


def test_all_classes_are_cut_at_the_least_joint_loss(noisy, spark):
    train, held = noisy
    settings = {"max_rounds": 25, "patience": 4, "step_size": 0.5}
    model = train_multiclass(train, ["a.b", "y"], validation=held, **settings)
    full = train_multiclass(train, ["a.b", "y"], **settings)
    rows = full.staged(held.drop("margins")).select("target", "margins").collect()
    want = []
    for step in range(25):
        total = 0.0
        for target, margins in rows:
            scores = [1 / (1 + math.exp(-2 * m[step])) for m in margins]
            total -= math.log(scores[target] / sum(scores))
        want.append(total / len(rows))
    best, stop = best_and_stop(want, 4)
    assert (model.rounds, len(model.losses)) == (best + 1, stop + 1) and stop < 24
    assert model.losses == pytest.approx(want[: stop + 1])
    # the cut model scores as the full one does after its rounds
    got = model.score(held.drop("margins")).select("i", "probability").collect()
    staged = {r["i"]: r["margins"] for r in full.staged(held.drop("margins")).collect()}
    for i, probability in got[:50]:
        scores = [1 / (1 + math.exp(-2 * m[best])) for m in staged[i]]
        assert probability == pytest.approx([s / sum(scores) for s in scores])


def test_margins_are_those_of_mllib(noisy, spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    train, held = noisy
    binary = train.withColumn("target", (F.col("target") == 1).cast("int"))
    model = train_binary(binary, ["a.b", "y"], max_rounds=8)
    named = [f.withColumnRenamed("a.b", "ab") for f in (binary, held)]
    vectors = [VectorAssembler(inputCols=["ab", "y"], outputCol="f").transform(f) for f in named]
    fitted = GBTClassifier(featuresCol="f", labelCol="target", maxIter=8, maxDepth=6, stepSize=0.3, maxBins=64, seed=42).fit(vectors[0].coalesce(1))
    want = {r[0]: r[1] for r in fitted.transform(vectors[1]).select("i", vector_to_array("probability")[1]).collect()}
    got = {r["i"]: r["probability"][1] for r in model.score(held).collect()}
    assert got == pytest.approx(want)


def test_losses_of_rows_without_a_label(noisy, spark):
    train, held = noisy
    model = train_multiclass(train, ["a.b", "y"], max_rounds=3, classes=3)
    staged = model.staged(held)
    odd = staged.withColumn("target", F.when(F.col("i") % 2 == 0, F.col("target")).when(F.col("i") % 3 == 0, 7))
    some = staged_log_loss(odd).orderBy("step").collect()
    even = staged_log_loss(staged.where("i % 2 = 0")).orderBy("step").collect()
    assert [r[1] for r in some] == pytest.approx([r[1] for r in even])
    assert staged_log_loss(staged.limit(0)).count() == 0
    # a validation part without rows stops nothing
    assert train_multiclass(train, ["a.b", "y"], validation=held.limit(0), max_rounds=3, classes=3).rounds == 3


def test_missing_values_have_a_learned_side(spark, tmp_path):
    rng, rows = random.Random(5), []
    for i in range(600):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        gone = rng.random() < 0.3
        x = None if gone and i % 2 else float("nan") if gone else x
        # missing counts as large for x, as small for y
        high_x, low_y = gone or x > 0.2, i % 5 == 0 or y < -0.3
        rows.append((i, x, None if i % 5 == 0 else y, int(high_x and low_y), int(high_x) + int(low_y)))
    table = spark.createDataFrame(rows, "i int, x double, y double, target int, three int")
    model = train_binary(table, ["x", "y"], max_rounds=20)
    assert model.score(table).where("prediction != target").count() == 0
    three = train_multiclass(table, ["x", "y"], "three", max_rounds=20)
    assert three.score(table).where("prediction != three").count() <= 6
    save_artifact(three, spark, str(tmp_path / "m"))
    loaded = load_artifact(spark, str(tmp_path / "m"))
    both = loaded.score(table).select("i", F.col("probability").alias("p")).join(three.score(table), "i")
    assert both.where(F.col("p") != F.col("probability")).count() == 0


def test_a_feature_missing_only_when_scored(spark):
    table = spark.createDataFrame([(i, float(i % 10), int(i % 10 > 4)) for i in range(200)], "i int, x double, target int")
    model = train_binary(table, ["x"], max_rounds=2)
    scored = model.score(table.withColumn("x", F.lit(None).cast("double")))
    assert {r["prediction"] for r in scored.collect()} == {1}
