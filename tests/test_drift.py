import bisect
import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.functions import kolmogorov as P
from tidemark.operators import drift as K


def _statistic(a, b):
    a, b = sorted(a), sorted(b)
    return max(
        abs(bisect.bisect_right(a, x) / len(a) - bisect.bisect_right(b, x) / len(b)) for x in a + b
    )


def test_small_exact_p_values():
    assert P.two_sample_p_value(1.0, 50, 51) == pytest.approx(2 / math.comb(101, 50), rel=1e-9)
    assert P.two_sample_p_value(0.01, 10_000, 9_999, "exact") == pytest.approx(P.two_sample_p_value(0.01, 10_000, 9_999, "asymptotic"), abs=0.01)
    for n1, n2, steps in ((7, 5, 20), (12, 8, 14), (9, 14, 60)):
        d = steps / math.lcm(n1, n2)
        assert P.two_sample_p_value(d, n1, n2) == pytest.approx(_by_fractions(n1, n2, Fraction(steps, math.lcm(n1, n2))), rel=1e-9)
    assert P.law_used(10_000, 5) == "exact" and P.law_used(10_001, 5) == "asymptotic"
    with pytest.raises(ValueError):
        P.law_used(1, 1, "other")


def _by_fractions(n1, n2, d):
    outside = {}
    for i in range(n1 + 1):
        for j in range(n2 + 1):
            if abs(Fraction(i, n1) - Fraction(j, n2)) >= d:
                outside[i, j] = Fraction(1)
            else:
                below = Fraction(j, i + j) * outside[i, j - 1] if j else 0
                left = Fraction(i, i + j) * outside[i - 1, j] if i else 0
                outside[i, j] = below + left
    return float(outside[n1, n2])


def _frame(spark, values, name="v"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"`{name}` double")


@pytest.mark.parametrize("n1,n2", [(3, 5), (4, 6), (5, 5), (6, 6), (2, 8), (1, 7)])
def test_exact_p_value_against_enumeration(n1, n2):
    gaps = []
    for chosen in itertools.combinations(range(n1 + n2), n1):
        mine = set(chosen)
        i = j = worst = 0
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in mine else (i, j + 1)
            worst = max(worst, abs(i * n2 - j * n1))
        gaps.append(worst)
    for gap in sorted(set(gaps)):
        want = sum(g >= gap for g in gaps) / len(gaps)
        assert P.two_sample_p_value(gap / (n1 * n2), n1, n2) == pytest.approx(want, abs=1e-12)


def test_p_value_edges():
    assert P.two_sample_p_value(0.0, 50, 50) == 1.0
    assert P.two_sample_p_value(0.2, 50, 50) == pytest.approx(0.2719135601522, abs=1e-12)
    assert P.two_sample_p_value(1.0, 50, 50) == pytest.approx(2 / math.comb(100, 50), rel=1e-9)
    assert math.isnan(P.two_sample_p_value(float("nan"), 5, 5))
    assert P.two_sample_p_value(0.5, 20_000, 20_000) == 0.0


@pytest.mark.parametrize("d", [0.008, 0.015, 0.02, 0.025])
def test_limiting_law_meets_the_exact_one(d):
    exact = P.two_sample_p_value(d, 10_000, 10_000)
    assert P._limiting(d, 10_000, 10_000) == pytest.approx(exact, abs=3e-3)


def test_statistic_against_brute_force(spark):
    rng = random.Random(5)
    for n1, n2 in ((50, 50), (30, 70), (1, 9)):
        a = [rng.choice([rng.random(), 0.5, 0.25]) for _ in range(n1)]
        b = [rng.choice([rng.random() ** 2, 0.5]) for _ in range(n2)]
        got = K.ks_statistic(_frame(spark, a), _frame(spark, b), ["v"]).first()
        assert (got.n1, got.n2) == (n1, n2)
        assert got.statistic == pytest.approx(_statistic(a, b), abs=1e-12)


def test_equal_disjoint_and_missing_samples(spark):
    same = K.drift_test(_frame(spark, [1, 2, 2, 3]), _frame(spark, [1, 2, 2, 3]), ["v"]).first()
    assert (same.statistic, same.p_value, same.drifted) == (0.0, 1.0, False)
    apart = K.drift_test(_frame(spark, range(20)), _frame(spark, range(100, 120)), ["v"]).first()
    assert apart.statistic == 1.0 and apart.drifted
    empty = K.drift_test(_frame(spark, [1, 2]), _frame(spark, []), ["v"]).first()
    assert empty.statistic is None and empty.p_value is None
    holed = K.drift_test(_frame(spark, [1, None]), _frame(spark, [1, 2]), ["v"]).first()
    assert holed.statistic is None and holed.p_value is None and not holed.drifted


def test_window_tests_against_brute_force(spark):
    rng = random.Random(9)
    ref = [rng.choice([rng.random(), 0.5]) for _ in range(40)]
    rows = [(w, rng.choice([rng.random() ** 2, 0.5])) for w in range(4) for _ in range(10 + 30 * (w == 2))]
    counts = (
        spark.createDataFrame(rows, "w int, x double").groupBy("w", "x").agg(F.count(F.lit(1)).alias("c2"))
    )
    got = {r.w: r for r in K.ks_by_window(_frame(spark, ref), "v", counts, ["w"]).collect()}
    for w in range(4):
        mine = [x for k, x in rows if k == w]
        assert got[w].n2 == len(mine) and got[w].n1 == 40
        assert got[w].statistic == pytest.approx(_statistic(ref, mine), abs=1e-12)


def test_gauges_are_named_per_feature(spark):
    tests = K.drift_test(_frame(spark, [1, 2], "sepal-length"), _frame(spark, [1, 3], "sepal-length"), ["sepal-length"])
    got = {r.metric: r.value for r in K.drift_gauges(tests, "job").collect()}
    assert got == pytest.approx({"sepal_length_ks_statistic": 0.5, "sepal_length_p_value": 1.0})


@pytest.mark.parametrize("accuracy", [0.3, 0.01, 0.001])
def test_sketches_stay_within_their_bound_and_size(spark, accuracy):
    rng = random.Random(9)
    draw = {"near": lambda: rng.gauss(0, 1), "far": lambda: rng.gauss(1, 2), "huge": lambda: rng.choice([1e15, -1e15, float("inf"), 1e-12, 0.0, -0.0, 3.0])}
    reference = [rng.gauss(0, 1) for _ in range(4000)] + [1e14, 0.0]
    rows = [(hour * 3600 + i, draw[name]()) for hour, name in enumerate(draw) for i in range(1500)]
    production = spark.createDataFrame(rows, "at long, `v.x` double").select(F.timestamp_seconds("at").alias("at"), "`v.x`")
    gone = production.limit(3).withColumn("v.x", F.lit(None).cast("double"))
    frame = _frame(spark, [*reference, None, float("nan")], "v.x")
    got = K.ks_by_window_sketched(frame, production.unionByName(gone), "v.x", "at", "1 hour", accuracy).orderBy("window_start").collect()
    assert len(got) == 3
    for hour, row in enumerate(got):
        exact = _statistic(reference, [v for at, v in rows if at // 3600 == hour])
        assert row["statistic"] - 1e-9 <= exact <= row["statistic"] + row["error_bound"] + 1e-9
        assert row["n2"] == 1500
    if accuracy == 0.01:
        assert got[0]["error_bound"] < 0.03
    buckets = production.select(K.value_bucket(F.col("`v.x`"), accuracy).alias("b"), "`v.x`")
    assert buckets.select("b").distinct().count() <= K.sketch_buckets(accuracy)
    ordered = [r["b"] for r in buckets.where("`v.x` is not null").orderBy("`v.x`").collect()]
    assert ordered == sorted(ordered)


def test_every_value_has_one_of_a_bounded_number_of_buckets(spark):
    values = [s * 10.0**e * m for s in (1, -1) for e in range(-14, 16) for m in (1.0, 1.7, 2.9, 4.1, 5.3, 9.9)]
    buckets = {r[0] for r in _frame(spark, values).select(K.value_bucket(F.col("v"), 0.3)).collect()}
    assert len(buckets) <= K.sketch_buckets(0.3) < 170
