import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.operators import splits as S


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 20, 101])
def test_chronological_sizes_and_order(spark, n):
    df = spark.range(n).select((F.lit(n) - F.col("id")).alias("t"))
    rows = S.chronological_split(df, ["t"]).orderBy("t").collect()
    a, b = int(n * 0.70), int(n * 0.15)
    assert [r.split for r in rows] == ["train"] * a + ["validation"] * b + ["test"] * (n - a - b)


def test_chronological_split_with_equal_keys_is_exact(spark):
    df = spark.range(100).select(F.lit(7).alias("t"), "id")
    sizes = {r.split: r.rows for r in S.part_sizes(S.chronological_split(df, ["t"])).collect()}
    assert sizes == {"train": 70, "validation": 15, "test": 15}


@pytest.mark.parametrize("hot", [False, True])
def test_sketched_boundaries_are_exact(spark, monkeypatch, hot):
    monkeypatch.setattr(ordering, "SMALL", 3)
    lead = F.when(F.col("id") < 200, 5) if hot else F.col("id") * 3
    df = spark.range(600).select(lead.alias("t"), "id").repartition(5)
    rows = S.chronological_split(df, ["t", "id"]).orderBy(F.col("t").asc_nulls_first(), "id").collect()
    assert [r.split for r in rows] == ["train"] * 420 + ["validation"] * 90 + ["test"] * 90


def test_timestamp_keys_survive_the_boundary_literal(spark):
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = [(start + dt.timedelta(microseconds=i),) for i in range(10)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, "t timestamp").withColumn("t", F.col("t").cast(kind))
        parts = S.chronological_split(df, ["t"], (0.8,), ("train", "test")).orderBy("t").collect()
        assert [r.split for r in parts] == ["train"] * 8 + ["test"] * 2


@pytest.mark.parametrize("n", [0, 1, 5, 11, 500])
def test_holdout_is_exact_disjoint_and_repeatable(spark, n):
    df = spark.range(n)
    first = {r.id: r.split for r in S.random_holdout(df, ["id"]).collect()}
    again = {r.id: r.split for r in S.random_holdout(df.repartition(7), ["id"]).collect()}
    assert first == again
    assert sum(v == "test" for v in first.values()) == math.ceil(0.2 * n)
    assert len(first) == n


def test_holdout_narrows_large_hash_ranges(spark, monkeypatch):
    monkeypatch.setattr(S, "SMALL", 1)
    got = S.random_holdout(spark.range(3000), ["id"]).filter("split = 'test'")
    order = spark.range(3000).orderBy(S.seeded_hash(42, ["id"])).limit(600)
    assert {r.id for r in got.collect()} == {r.id for r in order.collect()}


def test_holdout_with_one_key_on_a_third_of_rows(spark):
    df = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"), "id")
    assert S.random_holdout(df, ["k"]).filter("split = 'test'").count() == 60
    same = spark.range(50).select(F.lit(1).alias("k"))
    assert S.random_holdout(same, ["k"]).filter("split = 'test'").count() == 10


def test_sample_size_seed_and_error(spark):
    df = spark.range(200)
    first = {r.id for r in S.sample_exact(df, 50, ["id"], 42).collect()}
    assert len(first) == 50
    assert first == {r.id for r in S.sample_exact(df.repartition(9), 50, ["id"], 42).collect()}
    assert first != {r.id for r in S.sample_exact(df, 50, ["id"], 1).collect()}
    with pytest.raises(ValueError):
        S.sample_exact(df, 201, ["id"])


def test_large_sample_takes_the_same_rows_as_the_top_k(spark, monkeypatch):
    small = {r.id for r in S.sample_exact(spark.range(500), 120, ["id"]).collect()}
    monkeypatch.setattr(S, "SMALL", 100)
    assert {r.id for r in S.sample_exact(spark.range(500), 120, ["id"]).collect()} == small
