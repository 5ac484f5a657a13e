import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import backtest as B
from tidemark.operators import qlearning as Q


def _steps(spark, prices, actions):
    rows = [(i, float(p), a) for i, (p, a) in enumerate(zip(prices, actions))]
    return spark.createDataFrame(rows, "step int, price double, action int")


def _fold(prices, actions, balance):
    shares = 0
    for p, a in zip(prices, actions):
        if a == 1 and balance >= p:
            balance, shares = balance - p, shares + 1
        elif a == 2 and shares > 0:
            balance, shares = balance + p, shares - 1
        yield shares, balance, balance + shares * p


def _path(spark, prices, actions, balance):
    rows = B.backtest_path(_steps(spark, prices, actions), ["step"], (), balance).orderBy("step").collect()
    return [(r.shares, r.balance, r.net_worth) for r in rows]


@pytest.mark.parametrize(
    "actions,last",
    [([1], (1, 900.0, 1000.0)), ([1, 2], (0, 1000.0, 1000.0)), ([0], (0, 1000.0, 1000.0)), ([2], (0, 1000.0, 1000.0))],
)
def test_buy_sell_hold(spark, actions, last):
    assert _path(spark, [100] * len(actions), actions, 1000)[-1] == last


@pytest.mark.parametrize("balance", [1000.0, 60.0])
def test_nothing_is_traded_at_a_missing_price(spark, balance):
    rows = [(0, 50.0, 1), (1, None, 1), (2, float("nan"), 2), (3, 40.0, 1), (4, 70.0, 2), (5, None, 0)]
    df = spark.createDataFrame(rows, "step int, price double, action int")
    got = [(r.shares, r.balance, r.net_worth) for r in B.backtest_path(df, ["step"], (), balance).orderBy("step").collect()]
    shares, cash = 0, balance
    for (_, price, action), (held, left, worth) in zip(rows, got):
        known = price is not None and price == price
        if known and action == 1 and cash >= price:
            cash, shares = cash - price, shares + 1
        elif known and action == 2 and shares:
            cash, shares = cash + price, shares - 1
        assert (held, left) == (shares, cash)
        assert worth == cash + shares * price if known else worth is None or worth != worth


def test_refused_buys_and_negative_prices(spark):
    prices, actions = [50, 60, -10, 45, 70, 5], [1, 1, 1, 1, 2, 1]
    assert _path(spark, prices, actions, 60) == list(_fold(prices, actions, 60.0))


@pytest.mark.parametrize("balance", [100.0, 1e6])
@pytest.mark.parametrize("names,kind", [(("hot", None, "b"), "string"), ((7, None, 8), "int")])
def test_long_portfolios_against_a_plain_fold(spark, balance, names, kind):
    rng = random.Random(2)
    rows = [
        (name, i, float(rng.randint(-20, 100)), rng.choice([0, 1, 1, 2, 2, 7]))
        for name, n in zip(names, (800, 60, 90))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, f"name {kind}, step int, price double, action int")
    path = B.backtest_path(df.repartition(5), ["step"], ["name"], balance)
    got = {(r.name, r.step): (r.shares, r.balance, r.net_worth) for r in path.collect()}
    assert len(got) == len(rows)
    for name in names:
        mine = [r for r in rows if r[0] == name]
        for row, want in zip(mine, _fold([r[2] for r in mine], [r[3] for r in mine], balance)):
            assert got[row[:2]] == want


@pytest.mark.parametrize("most", [0, 60, 10_000])
def test_short_and_long_portfolios_agree(spark, monkeypatch, most):
    """Folded as arrays, replayed by partition, or some of both: the same paths, with all columns."""
    monkeypatch.setattr(B, "FOLD_ROWS", most)
    rng = random.Random(8)
    rows = [
        (name, i, rng.choice([float(rng.randint(1, 90)), None]) if i % 9 == 0 else float(rng.randint(1, 90)), rng.choice([1, 1, 2, 0, None]), f"n{i}")
        for name, n in (("a", 150), (None, 60), ("c", 40), ("rich", 3))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "`the name` string, step int, price double, action int, note string")
    got = B.backtest_path(df.repartition(4), ["step"], ["the name"], 200.0)
    assert got.columns == [*df.columns, "shares", "balance", "net_worth"]
    found = {(r["the name"], r["step"]): tuple(r)[2:] for r in got.collect()}
    for name in ("a", None, "c", "rich"):
        cash, shares = 200.0, 0
        for row in (r for r in rows if r[0] == name):
            _, step, price, action, note = row
            if price is not None and action == 1 and cash >= price:
                cash, shares = cash - price, shares + 1
            elif price is not None and action == 2 and shares:
                cash, shares = cash + price, shares - 1
            worth = None if price is None else cash + shares * price
            assert found[name, step] == (price, action, note, shares, cash, worth)


def test_summary_rewards_and_transitions(spark):
    df = _steps(spark, [100, 110, 90], [1, 0, 2])
    final = B.backtest_summary(B.backtest_path(df, ["step"], (), 1000.0), ["step"], (), 1000.0).first()
    assert (final.final_net_worth, final.total_profit, final.profit_percentage) == (990.0, -10.0, -1.0)
    rewards = B.step_reward(df, ["step"], (), 1000.0).orderBy("step").collect()
    # the last step sells first, so the fall earns nothing
    assert [r.reward for r in rewards] == [0.0, 10.0, 0.0]
    rows = B.transitions(df, ["price"], ["step"], (), 1000.0).orderBy("step").collect()
    assert [(r.state, r.next_state, r.done) for r in rows] == [
        ([100.0], [110.0], False), ([110.0], [90.0], False), ([90.0], [0.0], True)
    ]


def test_replay_batch_needs_enough_rows(spark):
    df = spark.range(3000)
    batch = {r.id for r in Q.replay_batch(df, ["id"]).collect()}
    assert len(batch) == 32 and min(batch) >= 1000
    assert Q.replay_batch(spark.range(31), ["id"]).count() == 0


def test_epsilon_schedule_matches_the_loop(spark):
    want, epsilon = [], 1.0
    for _ in range(1000):
        want.append(epsilon)
        if epsilon > 0.01:
            epsilon *= 0.995
    got = [r[0] for r in spark.range(1000).orderBy("id").select(Q.epsilon_after(F.col("id"))).collect()]
    assert got == pytest.approx(want)


def test_policy_explores_by_epsilon(spark):
    values = F.array(F.lit(1.0), F.lit(3.0), F.lit(2.0))
    df = spark.range(3000)
    assert {r[0] for r in df.select(Q.epsilon_greedy(values, 0.0, ["id"])).distinct().collect()} == {1}
    shares = {r[0]: r[1] for r in df.groupBy(Q.epsilon_greedy(values, 1.0, ["id"])).count().collect()}
    assert set(shares) == {0, 1, 2} and min(shares.values()) > 800


def test_fitted_q_finds_the_better_action(spark):
    # action 1 earns the state's value, action 2 loses it, 0 earns nothing; every step ends
    rows = [([s], a, {0: 0.0, 1: s, 2: -s}[a], [0.0], True) for s in (-2.0, -1.0, 1.0, 2.0) for a in (0, 1, 2)]
    df = spark.createDataFrame(rows, "state array<double>, action int, reward double, next_state array<double>, done boolean")
    q = Q.fitted_q(df, 1, iterations=2)
    picks = df.select("state", Q.epsilon_greedy(q.values("state"), 0.0, ["state"]).alias("a")).distinct().collect()
    assert {(r.state[0], r.a) for r in picks} == {(-2.0, 2), (-1.0, 2), (1.0, 1), (2.0, 1)}


def test_random_features_find_values_that_no_line_fits(spark, tmp_path):
    from tidemark.sources.models import load_artifact, save_artifact

    rng, rows = random.Random(4), []
    for _ in range(1500):
        x, y, a = rng.uniform(-2, 2), rng.uniform(-2, 2), rng.randrange(3)
        rows.append(([x, y], a, {0: 0.5, 1: x * x - 1, 2: -x * y}[a], [x / 2, y / 2], rng.random() < 0.5))
    rows += [([1.0, None], 1, 9.0, [0.0, 0.0], True), (None, 1, 9.0, [0.0, 0.0], True), ([0.0, 0.0], 7, 9.0, [0.0, 0.0], True)]
    df = spark.createDataFrame(rows, "state array<double>, action int, reward double, next_state array<double>, done boolean")
    once = Q.fitted_random_feature_q(df.where("done"), 2, features=100, iterations=1)
    for x, y in ((1.5, 0.2), (-1.5, 1.0), (0.1, 0.1), (1.2, -1.2)):
        assert once.of(np.array([[x, y]]))[0] == pytest.approx([0.5, x * x - 1, -x * y], abs=0.05)
    q = Q.fitted_random_feature_q(df, 2, features=100, iterations=3)
    # the second and third rounds by plain least squares on the same features
    kept = [r for r in rows if r[0] and None not in r[0] and r[1] < 3]
    weights = np.zeros((3, 101))
    for _ in range(3):
        target = [r[2] + (0 if r[4] else 0.95 * (q.features(np.array([r[3]])) @ weights.T).max()) for r in kept]
        fresh = np.zeros_like(weights)
        for a in range(3):
            phi = q.features(np.array([r[0] for r in kept if r[1] == a]))
            n = len(phi)
            moments = phi.T @ phi / n + np.diag([1e-6] * 100 + [0.0])
            fresh[a] = np.linalg.pinv(moments, hermitian=True) @ (phi.T @ np.array([t for t, r in zip(target, kept) if r[1] == a])) / n
        weights = fresh
    probe = np.array([[0.3, 0.4], [-1.0, 1.5]])
    assert q.of(probe) == pytest.approx(q.features(probe) @ weights.T, abs=1e-3)
    save_artifact(q, spark, str(tmp_path / "q"))
    loaded = load_artifact(spark, str(tmp_path / "q"))
    assert loaded == q
    valued = df.select("state", loaded.values("state").alias("q")).collect()
    assert all((r["q"] is None) == (r["state"] is None or None in r["state"]) for r in valued)
    assert valued[0]["q"] == pytest.approx(q.of(np.array([valued[0]["state"]]))[0].tolist())
