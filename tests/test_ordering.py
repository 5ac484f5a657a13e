import random

from pyspark.sql import functions as F

from tidemark.operators.ordering import PART, Running, boundary_rows, lay_out, row_position


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g string, i int, v bigint")


def _rows():
    rng = random.Random(1)
    rows = [("hot", i, rng.randint(-9, 9)) for i in range(300)]
    rows += [(None, i, rng.randint(-9, 9)) for i in range(20)]
    rows += [(f"s{i}", i, i) for i in range(40)]
    rng.shuffle(rows)
    return rows


def _groups(rows):
    groups = {}
    for g, i, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        groups.setdefault(g, []).append((i, v))
    return groups


def test_running_matches_brute_force_over_a_hot_group(spark):
    rows = _rows()
    laid = lay_out(_frame(spark, rows), ["i"], ["g"], partitions=6).with_running(
        total=Running("sum", F.col("v")),
        low=Running("min", F.col("v"), exclusive=True),
        high=Running("max", F.col("v")),
    )
    got = {(r.g, r.i): (r.total, r.low, r.high) for r in laid.rows().collect()}
    for g, members in _groups(rows).items():
        values = [v for _, v in members]
        for n, (i, _) in enumerate(members):
            assert got[(g, i)] == (
                sum(values[: n + 1]),
                min(values[:n], default=None),
                max(values[: n + 1]),
            )
    # the hot group is spread, not held by one partition
    assert laid.df.filter("g = 'hot'").select("_part").distinct().count() > 2


def test_neighbours_cross_partition_edges(spark):
    rows = _rows()
    laid = lay_out(_frame(spark, rows), ["i"], ["g"], partitions=6)
    ahead = {(r.g, r.i): r.x for r in laid.with_next(x=F.col("v")).rows().collect()}
    behind = {(r.g, r.i): r.x for r in laid.with_previous(x=F.col("v")).rows().collect()}
    for g, members in _groups(rows).items():
        values = [v for _, v in members]
        for n, (i, _) in enumerate(members):
            assert ahead[(g, i)] == (values[n + 1] if n + 1 < len(values) else None)
            assert behind[(g, i)] == (values[n - 1] if n else None)


def test_position_is_global_and_per_group(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k"))
    got = row_position(df, ["k"]).collect()
    assert {(r.k, r.position) for r in got} == {(k, k + 1) for k in range(1000)}
    grouped = row_position(df.withColumn("g", F.col("k") < 10), ["k"], ["g"]).collect()
    assert all(r.position == (r.k + 1 if r.g else r.k - 9) for r in grouped)


def test_a_key_shared_by_many_rows_is_spread(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("t"), "id")
    laid = lay_out(df, ["t"], partitions=8).with_position("p")
    sizes = [r["count"] for r in laid.df.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    assert sorted(r.p for r in laid.rows().collect()) == list(range(1, 4001))


def test_map_columns_travel_along(spark):
    df = spark.range(5).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    assert {(r.m["a"], r.position) for r in row_position(df, ["id"]).collect()} == {(i, i + 1) for i in range(5)}


def test_empty_and_single_row(spark):
    empty = spark.range(0).withColumnRenamed("id", "k")
    assert row_position(empty, ["k"]).count() == 0
    assert lay_out(empty, ["k"]).with_next(x=F.col("k")).rows().count() == 0
    one = row_position(spark.range(1), ["id"]).first()
    assert one.position == 1


def test_boundary_rows(spark):
    found = boundary_rows(spark.range(100), ["id"], [1, 50, 99], 100)
    assert {c: (a["id"], b["id"]) for c, (a, b) in found.items()} == {1: ("0", "1"), 50: ("49", "50"), 99: ("98", "99")}


def test_no_plan_step_gathers_all_rows(spark):
    laid = lay_out(spark.range(1000), ["id"]).with_position("p").with_next(x=F.col("id"))
    plan = laid.df._jdf.queryExecution().executedPlan().toString()
    # single-partition exchanges appear only above the per-partition totals
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "Aggregate" in part


def test_copies_of_one_row_spread_over_partitions(spark):
    laid = lay_out(spark.range(4000).select(F.lit(1).alias("k"), F.lit("x").alias("v.1")), ["k"], partitions=8)
    sizes = [r["count"] for r in laid.df.groupBy(PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2000
    assert sorted(r.position for r in row_position(laid.rows(), ["k"]).collect()) == list(range(1, 4001))


def test_neighbours_need_no_sorting_aggregate(spark, capsys):
    laid = lay_out(spark.range(500).withColumn("g", F.col("id") % 3), ["id"], by=["g"], partitions=4)
    laid.with_next(after=F.col("id")).rows().explain("simple")
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    # the wide rows move once, to their partition's task
    assert plan.split("Initial Plan")[0].count("repartitionbyid") + plan.count("REPARTITION_BY_NUM") <= 2
