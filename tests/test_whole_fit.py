"""Fits on more rows than MLlib bins whole: all rows count, as cells of equal bins and labels."""

import datetime
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import boosting
from tidemark.operators.boosting import train_binary, train_multiclass
from tidemark.operators.cells import COUNT, bin_edges, cells
from tidemark.operators.evaluation import staged_log_loss
from tidemark.plans import queries_models

ROWS = 12_000


@pytest.fixture(scope="module")
def table(spark):
    rng, rows = random.Random(7), []
    for i in range(ROWS):
        x, y = float(rng.randrange(40)), rng.randrange(30) / 7 - 2
        label = min(int(x / 14 + (y > 0) + 0.4 * rng.random()), 2) if rng.random() < 0.8 else rng.randrange(3)
        gap = rng.random() < 0.2
        rows.append((i, x, y, rng.gauss(0, 1), None if gap else float("nan") if i % 50 == 0 else x, 2 if gap else label))
    return spark.createDataFrame(rows, "i int, `a.b` double, y double, wide double, gaps double, target int").cache()


def margins(model, table):
    return np.array([r[0] for r in model.staged(table).orderBy("i").select("margins").collect()])


def test_the_query_fits_on_all_training_rows(spark, tmp_path, monkeypatch):
    day = datetime.datetime(2024, 1, 1)
    lines = [(i, 1, i, i, float(i % 50 + 1), i / 7, 0.01 * (i % 11), 0.01 * (i % 9), "A", "F", day) for i in range(ROWS)]
    schema = """l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double,
                l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    given = {}

    def fit(train, features, validation, classes):
        given.update(train=train.count(), validation=validation.count())
        return train_multiclass(train, features, validation=validation, classes=classes, max_rounds=3)

    monkeypatch.setattr(queries_models, "train_multiclass", fit)
    counts = queries_models.g1_train_multiclass(spark, str(tmp_path)).collect()
    assert given == {"train": ROWS * 4 // 5, "validation": ROWS // 5}
    assert all(r["target"] == r["prediction"] for r in counts) and sum(r["rows"] for r in counts) == ROWS // 5


def test_single_rows_have_bins_of_their_own(spark):
    # only splits at 9.5, 10.5 and 11.5 tell three rows among 40,000 apart
    rows = spark.range(40_000).select((F.col("id") % 10).cast("double").alias("x"), F.lit(0).alias("target"))
    rare = spark.createDataFrame([(10.0, 1), (11.0, 0), (12.0, 1)], "x double, target int")
    model = train_binary(rows.union(rare), ["x"], max_rounds=3)
    assert [r[0] for r in model.score(rare).orderBy("x").select("prediction").collect()] == [1, 0, 1]


@pytest.mark.parametrize("most", [boosting._GATHERED, 0])
def test_cells_are_fitted_as_mllib_fits_their_rows(table, monkeypatch, most):
    monkeypatch.setattr(boosting, "_GATHERED", most)
    binary = table.withColumn("target", (F.col("target") == 1).cast("int"))
    model = train_binary(binary, ["a.b", "y"], max_rounds=6)
    vectors = VectorAssembler(inputCols=["ab", "y"], outputCol="f").transform(binary.withColumnRenamed("a.b", "ab"))
    # 110 bins squared are more than the rows: MLlib looks at all of them
    fitted = GBTClassifier(featuresCol="f", labelCol="target", maxIter=6, maxDepth=6, stepSize=0.3, maxBins=110, seed=42).fit(vectors.coalesce(1))
    want = [r[0] for r in fitted.transform(vectors).orderBy("i").select(vector_to_array("probability")[1]).collect()]
    got = [r[0] for r in model.score(binary).orderBy("i").select(F.col("probability")[1]).collect()]
    assert got == pytest.approx(want, abs=1e-9)


def test_one_task_and_mllib_grow_the_same_trees(table, monkeypatch):
    features, settings = ["gaps", "y", "wide"], {"classes": 3, "max_rounds": 5}
    one = train_multiclass(table, features, **settings)
    monkeypatch.setattr(boosting, "_GATHERED", 0)
    assert margins(one, table) == pytest.approx(margins(train_multiclass(table, features, **settings), table), abs=1e-9)
    # missing values are a class of their own there
    assert one.score(table).where("gaps IS NULL AND prediction != 2").count() == 0


def test_losses_of_cells_are_those_of_their_rows(table):
    train, held = table.where("i % 13 != 0"), table.where("i % 13 = 0").withColumn("target", F.when(F.col("i") % 3 > 0, F.col("target")))
    features, settings = ["gaps", "wide"], {"classes": 3, "max_rounds": 12, "patience": 3, "step_size": 1.0}
    model, full = train_multiclass(train, features, validation=held, **settings), train_multiclass(train, features, **settings)
    want = [r["log_loss"] for r in staged_log_loss(full.staged(held)).orderBy("step").collect()]
    best, stop = boosting.best_and_stop(want, 3)
    assert model.losses == pytest.approx(want[: stop + 1]) and model.rounds == best + 1


def test_bins_hold_equal_shares_of_all_rows(spark):
    rng = np.random.default_rng(2)
    wide = np.concatenate([rng.normal(size=3_000), np.full(900, 0.25), [np.inf, -np.inf]])
    rows = [(float(v), float(i % 5), None, float("nan") if i % 4 == 0 else -0.0) for i, v in enumerate(wide)]
    frame = spark.createDataFrame(rows, "wide double, few double, none double, zero double").withColumn("target", F.lit(1))
    features = ["wide", "few", "none", "zero"]
    edges = bin_edges(frame, features, 16)
    assert [list(e) for e in edges[1:]] == [[0.5, 1.5, 2.5, 3.5, 4.0], [0.0], [0.0]]
    ordered = np.sort(wide)
    want = np.unique(ordered[[-(-k * len(wide) // 16) - 1 for k in range(1, 17)]])
    assert list(edges[0]) == list(want)
    found = cells(frame, features, edges, "target", "label").toPandas()
    assert found[COUNT].sum() == len(wide) and len(found) < 16 * 5 * 2 + 1
    assert found["none"].isna().all() and set(found["few"]) == {0.5, 1.5, 2.5, 3.5, 4.0}


def test_a_missing_label_is_refused(table):
    with pytest.raises(ValueError, match="no target"):
        train_binary(table.withColumn("target", F.when(F.col("i") > 0, F.lit(1))), ["y"], max_rounds=2)
