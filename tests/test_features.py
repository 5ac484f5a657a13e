import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import decisions as D
from tidemark.operators import features as X
from tidemark.plans.jobs import prepare_series


def test_scaler_uses_population_deviation_and_guards_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, 2.0)], "a double, b double, c double")
    scaled = X.apply_scaler(df, X.fit_scaler(df), ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0, None), (1.0, 0.0, 0.0)]


def test_scaler_ignores_nan_and_fits_on_a_part(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (100.0,)], "a double")
    fitted = X.fit_scaler(df, ["a"], F.col("a") < 50).first()
    assert (fitted.a_mean, fitted.a_scale) == (2.0, 1.0)


@pytest.mark.parametrize("hole", [None, float("nan")])
def test_direction_label_with_missing_values(spark, hole):
    values = [hole, 1.0, 2.0, hole, 3.0, 2.0, hole]
    df = spark.createDataFrame(list(enumerate(values)), "t int, v double").orderBy(F.desc("t"))
    got = [r.target for r in X.next_direction(df, "v", ["t"]).orderBy("t").collect()]
    assert got == [0, 1, 0, 0, 0, 0, 0]


def test_single_row_series_is_kept(spark):
    df = spark.createDataFrame([(1, 2.0)], "t int, v double")
    assert X.next_direction(df, "v", ["t"]).first().target == 0


@pytest.mark.parametrize("bound", [256, 1])
def test_labels_keep_numeric_order(spark, monkeypatch, bound):
    monkeypatch.setattr(X, "_LITERAL_CLASSES", bound)
    df = spark.createDataFrame([(10,), (2,), (1,), (2,), (None,)], "y int")
    got = {(r.y, r.target) for r in X.encode_labels(df, "y").collect()}
    assert got == {(1, 0), (2, 1), (10, 2), (None, None)}


def test_next_state_ends_with_zeros(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "t int, s array<double>")
    got = [(r.next_state, r.done) for r in X.next_state(df, "s", 2, ["t"]).orderBy("t").collect()]
    assert got == [([3.0, 4.0], False), ([0.0, 0.0], True)]


def test_prepare_series_drops_incomplete_rows_after_labelling(spark):
    rows = [("2024-01-0%d" % (i + 1), v, "text") for i, v in enumerate([1.0, 2.0, None, 1.0])]
    df = spark.createDataFrame(rows, "date string, close double, note string").withColumn("date", F.to_timestamp("date"))
    got = prepare_series(df, "close").orderBy("date").collect()
    assert [r.target for r in got] == [1, 0, 0]
    assert "note" not in got[0].asDict()


def test_column_operators(spark):
    df = spark.createDataFrame([("x", True, 1, 2.0), ("y", None, 2, float("nan"))], "s string, b boolean, i int, d double")
    assert C.select_numeric(df).columns == ["i", "d"]
    assert C.drop_incomplete(df).count() == 1
    assert C.nan_to_null(df).filter("d IS NULL").count() == 1
    assert C.cast_columns(df, {"s": "double"}).filter("s IS NULL").count() == 2
    key = spark.range(1).select(C.metric_key(F.lit("sepal-length"), "p_value")).first()[0]
    assert key == "sepal_length_p_value"


def test_decisions(spark):
    row = spark.range(1).select(
        D.argmax(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))),
        D.binary_decision(F.lit(0.5)),
        D.registration_gate(F.lit(0.52)),
        D.registration_gate(F.lit(0.5199)),
        D.drift_flag(F.lit(0.049)),
        D.drift_flag(F.lit(0.05)),
        D.drift_flag(F.lit(float("nan"))),
        D.replace_element(F.array(F.lit(1.0), F.lit(2.0)), F.lit(1), F.lit(9.0)),
    ).first()
    assert list(row) == [1, 0, "register", "artifact_only", True, False, False, [1.0, 9.0]]
