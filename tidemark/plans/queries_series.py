"""Queries on order, splits, samples, labels, scaling and back-tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import backtest as B
from tidemark.operators import qlearning as Q
from tidemark.operators import splits as S
from tidemark.operators.evaluation import early_stop_round
from tidemark.operators.features import (
    apply_scaler,
    encode_labels,
    fit_scaler,
    next_direction,
    next_state,
    previous_value,
)
from tidemark.operators.ordering import Running, lay_out, row_position
from tidemark.plans.catalog import query, table
from tidemark.plans.inputs import (
    ACTION_SQL,
    CUSTOMER_BALANCE,
    FEATURES,
    LINE_KEYS,
    LINE_TIES,
    SERIES_SQL,
    STEP,
    daily_series,
    labelled_lines,
    portfolio_steps,
)

_SPLIT_SQL = """
SELECT o_orderkey,
       CASE WHEN rn <= floor(n * {first}::DOUBLE) THEN 'train' {middle} ELSE 'test' END AS split
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
"""
_SPLIT_3 = _SPLIT_SQL.format(
    first="0.7",
    middle="WHEN rn <= floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation'",
)
_LINE_HASH = "md5(concat_ws('|', '{seed}', l_orderkey, l_linenumber, l_partkey, l_suppkey))"


@query(
    "c0_row_position",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS position FROM orders",
)
def c0_row_position(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*STEP)
    return row_position(orders, STEP).select("o_orderkey", "position")


@query(
    "c0_position_by_group",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS position
       FROM orders""",
)
def c0_position_by_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", *STEP)
    return row_position(orders, STEP, ["o_orderpriority"]).select("o_orderkey", "position")


@query(
    "c0_running_total",
    """SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderdate, o_orderkey
              ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM orders""",
)
def c0_running_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*STEP, "o_totalprice")
    money = F.col("o_totalprice").cast("decimal(18,2)")
    running = lay_out(orders, STEP).with_running(total=Running("sum", money)).rows()
    return running.select("o_orderkey", F.col("total").cast("double").alias("total"))


@query("c1_sort_by_time", f"SELECT CAST(date AS VARCHAR) AS date, price, n_orders FROM ({SERIES_SQL}) ORDER BY 1")
def c1_sort_by_time(spark, sf_dir):
    ordered = S.sort_by_time(daily_series(spark, sf_dir), ["date"])
    return ordered.select(F.col("date").cast("string").alias("date"), "price", "n_orders")


@query("c2_split_70_15_15", _SPLIT_3)
def c2_split_70_15_15(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*STEP)
    return S.chronological_split(orders, STEP).select("o_orderkey", "split")


@query("c3_split_80_20", _SPLIT_SQL.format(first="0.8", middle=""))
def c3_split_80_20(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*STEP)
    return S.chronological_split(orders, STEP, (0.8,), ("train", "test")).select("o_orderkey", "split")


@query("e9_split_sizes", f"SELECT split, count(*) AS rows FROM ({_SPLIT_3}) GROUP BY 1")
def e9_split_sizes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(*STEP)
    return S.part_sizes(S.chronological_split(orders, STEP))


@query(
    "c4_holdout_exact",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               CASE WHEN rn <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY {_LINE_HASH.format(seed=42)}, l_shipdate, l_extendedprice) AS rn
              FROM lineitem)""",
)
def c4_holdout_exact(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    return S.random_holdout(rows, LINE_KEYS, ties=LINE_TIES).select(*LINE_KEYS, "l_extendedprice", "split")


@query(
    "c5_sample_exact",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
        ORDER BY {_LINE_HASH.format(seed=42)}, l_shipdate, l_extendedprice LIMIT 50""",
)
def c5_sample_exact(spark, sf_dir):
    rows = labelled_lines(spark, sf_dir)
    return S.sample_exact(rows, 50, LINE_KEYS, 42, LINE_TIES).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "c6_preview_projection",
    "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 10",
)
def c6_preview_projection(spark, sf_dir):
    return S.preview(table(spark, sf_dir, "events"), ["ts", "event_id"], 10).select("event_id", "event_type")


@query(
    "d1_next_direction",
    """SELECT o_orderkey, CAST(coalesce(lead(p) OVER (ORDER BY o_orderdate, o_orderkey) > p, false) AS BIGINT) AS target
       FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS p FROM orders)""",
)
def d1_next_direction(spark, sf_dir):
    """One long series with missing prices, some null and some NaN."""
    priced = table(spark, sf_dir, "orders").select(
        *STEP,
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan")))
        .alias("p"),
    )
    return next_direction(priced, "p", STEP).select("o_orderkey", "target")


@query(
    "d1_next_direction_by_group",
    """SELECT o_orderkey, CAST(coalesce(lead(o_totalprice) OVER (PARTITION BY o_orderpriority
              ORDER BY o_orderdate, o_orderkey) > o_totalprice, false) AS BIGINT) AS target FROM orders""",
)
def d1_next_direction_by_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", *STEP, "o_totalprice")
    return next_direction(orders, "o_totalprice", STEP, ["o_orderpriority"]).select("o_orderkey", "target")


@query(
    "d2_previous_price",
    """SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
              AS previous FROM orders""",
)
def d2_previous_price(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", *STEP, "o_totalprice")
    return previous_value(orders, "o_totalprice", STEP, ["o_orderpriority"]).select("o_orderkey", "previous")


@query(
    "d3_next_state",
    """SELECT o_orderkey, coalesce(lead(o_totalprice) OVER w, 0.0) AS next_price,
              CAST(coalesce(lead(o_custkey) OVER w, 0) AS DOUBLE) AS next_second,
              lead(o_orderkey) OVER w IS NULL AS done
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def d3_next_state(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    state = F.array("o_totalprice", F.col("o_custkey").cast("double"))
    rows = orders.select("o_custkey", *STEP, state.alias("state"))
    return next_state(rows, "state", 2, STEP, ["o_custkey"]).select(
        "o_orderkey",
        F.col("next_state")[0].alias("next_price"),
        F.col("next_state")[1].alias("next_second"),
        "done",
    )


_ROUNDS_SQL = """SELECT concat('run_', CAST(user_id AS VARCHAR)) AS run_id, value,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step FROM events"""


@query(
    "d4_early_stop_round",
    f"""WITH r AS ({_ROUNDS_SQL}),
    b AS (SELECT *, min(value) OVER (PARTITION BY run_id ORDER BY step
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM r),
    l AS (SELECT *, max(CASE WHEN best_before IS NULL OR value < best_before THEN step END)
                      OVER (PARTITION BY run_id ORDER BY step) AS last_improved FROM b),
    s AS (SELECT run_id, coalesce(min(CASE WHEN step - last_improved >= 10 THEN step END), max(step)) AS stop_round
          FROM l GROUP BY 1)
    SELECT r.run_id, arg_min(r.step, (r.value, r.step)) AS best_round, s.stop_round
    FROM r JOIN s USING (run_id) WHERE r.step <= s.stop_round GROUP BY r.run_id, s.stop_round""",
)
def d4_early_stop_round(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"), "event_id", "value"
    )
    rounds = row_position(events, ["event_id"], ["run_id"], "step").withColumn("step", F.col("step") - 1)
    return early_stop_round(rounds.drop("event_id"))


@query(
    "e1_fit_scaler",
    "SELECT "
    + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_scale" for c in FEATURES)
    + " FROM lineitem",
)
def e1_fit_scaler(spark, sf_dir):
    fitted = fit_scaler(table(spark, sf_dir, "lineitem"), FEATURES)
    return fitted.select(*[F.round(c, 6).alias(c) for c in fitted.columns])


@query(
    "e1_fit_on_training",
    "SELECT round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_pop(l_quantity), 6) AS l_quantity_scale "
    "FROM lineitem WHERE l_linestatus = 'O'",
)
def e1_fit_on_training(spark, sf_dir):
    fitted = fit_scaler(table(spark, sf_dir, "lineitem"), ["l_quantity"], F.col("l_linestatus") == "O")
    return fitted.select(*[F.round(c, 6).alias(c) for c in fitted.columns])


@query(
    "e2_apply_scaler",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"round((l.{c} - f.m{i}) / f.s{i}, 6) AS {c}" for i, c in enumerate(FEATURES))
    + " FROM lineitem l, (SELECT "
    + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(FEATURES))
    + " FROM lineitem) f",
)
def e2_apply_scaler(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *FEATURES)
    scaled = apply_scaler(lines, fit_scaler(lines, FEATURES), FEATURES)
    return scaled.withColumns({c: F.round(c, 6) for c in FEATURES})


@query(
    "e3_label_encode",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS target FROM lineitem",
)
def e3_label_encode(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return encode_labels(lines, "l_returnflag").drop("l_returnflag")


@query(
    "e3_label_encode_numeric",
    "SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS target FROM orders",
)
def e3_label_encode_numeric(spark, sf_dir):
    """Integer labels keep numeric order; there are too many for a literal list."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return encode_labels(orders, "o_custkey").drop("o_custkey")


# the trading rules, one step at a time
_PATH_SQL = f"""
WITH RECURSIVE o AS (
  SELECT o_custkey, o_orderkey, o_totalprice AS price, {ACTION_SQL} AS action,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS step FROM orders),
t AS (
  SELECT o_custkey, o_orderkey, step, price, action,
         CASE WHEN action = 1 AND {CUSTOMER_BALANCE} >= price THEN {CUSTOMER_BALANCE}::DOUBLE - price ELSE {CUSTOMER_BALANCE}::DOUBLE END AS balance,
         CASE WHEN action = 1 AND {CUSTOMER_BALANCE} >= price THEN 1 ELSE 0 END AS shares, NULL::DOUBLE AS price_before
  FROM o WHERE step = 1
  UNION ALL
  SELECT o.o_custkey, o.o_orderkey, o.step, o.price, o.action,
         CASE WHEN o.action = 1 AND t.balance >= o.price THEN t.balance - o.price
              WHEN o.action = 2 AND t.shares > 0 THEN t.balance + o.price ELSE t.balance END,
         CASE WHEN o.action = 1 AND t.balance >= o.price THEN t.shares + 1
              WHEN o.action = 2 AND t.shares > 0 THEN t.shares - 1 ELSE t.shares END, t.price
  FROM t JOIN o ON o.o_custkey = t.o_custkey AND o.step = t.step + 1)
"""


def _customer_path(spark, sf_dir):
    steps = portfolio_steps(spark, sf_dir).drop("o_orderpriority")
    return B.backtest_path(steps, STEP, ["o_custkey"], CUSTOMER_BALANCE)


@query(
    "h1_backtest_path",
    _PATH_SQL
    + """SELECT o_orderkey, CAST(shares AS BIGINT) AS shares, round(balance, 2) AS balance,
                round(balance + shares * price, 2) AS net_worth FROM t""",
)
def h1_backtest_path(spark, sf_dir):
    """One portfolio per customer; some buys are refused."""
    return _customer_path(spark, sf_dir).select(
        "o_orderkey",
        "shares",
        F.round("balance", 2).alias("balance"),
        F.round("net_worth", 2).alias("net_worth"),
    )


_SCALED_SQL = """
WITH o AS (
  SELECT o_orderpriority, o_orderkey, (o_totalprice - m) / s AS price,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN -1 ELSE 0 END AS wish,
         row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS step
  FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)),
n AS (SELECT *, sum(wish) OVER (PARTITION BY o_orderpriority ORDER BY step) AS net FROM o),
f AS (SELECT *, net - least(0, min(net) OVER (PARTITION BY o_orderpriority ORDER BY step)) AS shares FROM n),
p AS (SELECT *, shares - coalesce(lag(shares) OVER (PARTITION BY o_orderpriority ORDER BY step), 0) AS bought FROM f)
"""


@query(
    "h1_backtest_scaled_prices",
    _SCALED_SQL
    + """SELECT o_orderkey, CAST(shares AS BIGINT) AS shares,
                round(10000 - sum(bought * price) OVER (PARTITION BY o_orderpriority ORDER BY step), 4) AS balance FROM p""",
)
def h1_backtest_scaled_prices(spark, sf_dir):
    """Five long portfolios on z-scored prices, where every buy is affordable."""
    steps = portfolio_steps(spark, sf_dir).drop("o_custkey")
    scaled = apply_scaler(steps, fit_scaler(steps, ["price"]), ["price"])
    path = B.backtest_path(scaled, STEP, ["o_orderpriority"])
    return path.select("o_orderkey", "shares", F.round("balance", 4).alias("balance"))


@query(
    "h2_step_reward",
    _PATH_SQL
    + f"""SELECT o_orderkey, round(CASE WHEN price_before IS NULL THEN balance + shares * price - {CUSTOMER_BALANCE}
                 ELSE shares * (price - price_before) END, 2) AS reward FROM t""",
)
def h2_step_reward(spark, sf_dir):
    steps = portfolio_steps(spark, sf_dir).drop("o_orderpriority")
    rewarded = B.step_reward(steps, STEP, ["o_custkey"], CUSTOMER_BALANCE)
    return rewarded.select("o_orderkey", F.round("reward", 2).alias("reward"))


@query(
    "e10_backtest_summary",
    _PATH_SQL
    + f"""SELECT o_custkey, round(w, 2) AS final_net_worth, round(w - {CUSTOMER_BALANCE}, 2) AS total_profit,
                 round((w - {CUSTOMER_BALANCE}) / {CUSTOMER_BALANCE} * 100, 6) AS profit_percentage
          FROM (SELECT o_custkey, arg_max(balance + shares * price, step) AS w FROM t GROUP BY 1)""",
)
def e10_backtest_summary(spark, sf_dir):
    summary = B.backtest_summary(_customer_path(spark, sf_dir), STEP, ["o_custkey"], CUSTOMER_BALANCE)
    return summary.select(
        "o_custkey",
        F.round("final_net_worth", 2).alias("final_net_worth"),
        F.round("total_profit", 2).alias("total_profit"),
        F.round("profit_percentage", 6).alias("profit_percentage"),
    )


_TRANSITION_FEATURES = ["price", "o_custkey"]


def _transitions(spark, sf_dir):
    steps = portfolio_steps(spark, sf_dir).drop("o_orderpriority")
    return B.transitions(steps, _TRANSITION_FEATURES, STEP, ["o_custkey"], CUSTOMER_BALANCE)


_TRANSITION_SQL = (
    _PATH_SQL
    + f""", m AS (SELECT o_orderkey, price, action, coalesce(lead(price) OVER w, 0.0) AS next_price,
                 lead(price) OVER w IS NULL AS done,
                 CASE WHEN price_before IS NULL THEN balance + shares * price - {CUSTOMER_BALANCE}
                      ELSE shares * (price - price_before) END AS reward
          FROM t WINDOW w AS (PARTITION BY o_custkey ORDER BY step))
"""
)


@query(
    "h3_transitions",
    _TRANSITION_SQL
    + "SELECT o_orderkey, price, CAST(action AS INTEGER) AS action, round(reward, 2) AS reward, next_price, done FROM m",
)
def h3_transitions(spark, sf_dir):
    return _transitions(spark, sf_dir).select(
        "o_orderkey",
        F.col("state")[0].alias("price"),
        F.col("action").cast("int").alias("action"),
        F.round("reward", 2).alias("reward"),
        F.col("next_state")[0].alias("next_price"),
        "done",
    )


@query(
    "h4_replay_batch",
    """SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 2000)
       ORDER BY md5(concat_ws('|', '42', o_orderkey, o_custkey)) LIMIT 32""",
)
def h4_replay_batch(spark, sf_dir):
    """Newest 2,000 orders, then a seeded sample of 32."""
    orders = table(spark, sf_dir, "orders").select(*STEP, "o_custkey")
    return Q.replay_batch(orders, STEP, keys=["o_orderkey", "o_custkey"]).select("o_orderkey")


# action values for the policy and target queries: simple functions of the price
_Q_SQL = "[sqrt({p}), sqrt({p} * 2) - 150, sqrt({p} / 3) + 100]"


def _values(price: str):
    p = F.col(price)
    return F.array(F.sqrt(p), F.sqrt(p * 2) - 150, F.sqrt(p / 3) + 100)


@query(
    "h5_bellman_target",
    _TRANSITION_SQL
    + f""", q AS (SELECT *, {_Q_SQL.format(p='price')} AS q, CASE WHEN done THEN reward
                 ELSE reward + 0.95 * list_max({_Q_SQL.format(p='next_price')}) END AS target FROM m)
       SELECT o_orderkey, round(target, 6) AS target,
              round(CASE WHEN action = 0 THEN target ELSE q[1] END, 6) AS q0,
              round(CASE WHEN action = 1 THEN target ELSE q[2] END, 6) AS q1,
              round(CASE WHEN action = 2 THEN target ELSE q[3] END, 6) AS q2 FROM q""",
)
def h5_bellman_target(spark, sf_dir):
    seen = _transitions(spark, sf_dir).withColumns(
        {"price": F.col("state")[0], "next_price": F.col("next_state")[0]}
    )
    valued = seen.withColumns({"q": _values("price"), "q_next": _values("next_price")})
    return Q.with_target(valued).select(
        "o_orderkey",
        F.round("target", 6).alias("target"),
        *[F.round(F.col("q_target")[i], 6).alias(f"q{i}") for i in range(3)],
    )


def _draw(seed: int) -> str:
    return f"CAST(concat('0x', substr(md5(concat_ws('|', '{seed}', o_orderkey, o_custkey)), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"


@query(
    "h6_epsilon_greedy",
    f"""SELECT o_orderkey, CAST(CASE WHEN {_draw(42)} <= 0.25 THEN floor({_draw(43)} * 3)
               ELSE list_position(q, list_max(q)) - 1 END AS INTEGER) AS action
        FROM (SELECT *, {_Q_SQL.format(p='o_totalprice')} AS q FROM orders)""",
)
def h6_epsilon_greedy(spark, sf_dir):
    action = Q.epsilon_greedy(_values("o_totalprice"), 0.25, ["o_orderkey", "o_custkey"])
    return table(spark, sf_dir, "orders").select("o_orderkey", action.alias("action"))


@query(
    "h6_epsilon_schedule",
    """SELECT event_id, round(power(0.995::DOUBLE, least(event_id, 919)), 8) AS epsilon FROM events""",
)
def h6_epsilon_schedule(spark, sf_dir):
    """Exploration rate after as many replays as the event id says."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(Q.epsilon_after(F.col("event_id")), 8).alias("epsilon")
    )


# rewards linear in the state, per action: slope and constant; every step leads to the state 0
_REWARDS = ((1.0, 2.0), (-1.0, 5.0), (0.5, 3.0))
_LASTING = "5.0 * 0.95::DOUBLE * (1 - power(0.95::DOUBLE, 9)) / (1 - 0.95::DOUBLE)"


@query(
    "h7_fitted_q",
    f"""WITH s AS (SELECT o_orderkey, o_totalprice / 100000.0::DOUBLE AS x FROM orders),
        q AS (SELECT o_orderkey, [{", ".join(f"{a} * x + {b} + {_LASTING}" for a, b in _REWARDS)}] AS q FROM s)
        SELECT o_orderkey, CAST(list_position(q, list_max(q)) - 1 AS INTEGER) AS greedy_action,
               round(q[1], 4) AS q0, round(q[2], 4) AS q1, round(q[3], 4) AS q2 FROM q""",
)
def h7_fitted_q(spark, sf_dir):
    """Fitted Q-iteration over all orders, on rewards whose values after ten rounds are known.

    The state 0 is worth most to action 1: 5 in the first round, and 0.95 of
    the round before more in each that follows.
    """
    state = F.array(F.col("o_totalprice").cast("double") / 100_000.0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", state.alias("state"))
    action = (F.col("o_custkey") % 3).cast("int")
    reward = F.lit(0.0)
    for a, (slope, constant) in enumerate(_REWARDS):
        reward = F.when(action == a, F.col("state")[0] * slope + constant).otherwise(reward)
    seen = orders.select(
        "state", action.alias("action"), reward.alias("reward"), F.array(F.lit(0.0)).alias("next_state"), F.lit(False).alias("done")
    )
    q = Q.fitted_q(seen, 1, regularisation=0.0).values("state")
    valued = orders.withColumn("q", q)
    greedy = Q.epsilon_greedy(F.col("q"), 0.0, ["o_orderkey"])
    return valued.select("o_orderkey", greedy.alias("greedy_action"), *[F.round(F.col("q")[i], 4).alias(f"q{i}") for i in range(3)])


# rewards of the three actions in waves of the price, which no linear model fits
_WAVES = ("0.3", "sin(2 * x)", "cos(3 * x)")


@query(
    "h7_fitted_q_nonlinear",
    f"""WITH s AS (SELECT o_orderkey, o_totalprice / 100000.0::DOUBLE AS x FROM orders),
        q AS (SELECT o_orderkey, [{", ".join(f"({w})::DOUBLE" for w in _WAVES)}] AS q FROM s)
        SELECT o_orderkey, CAST(list_position(q, list_max(q)) - 1 AS INTEGER) AS greedy_action FROM q
        WHERE list_max(q) - list_sort(q)[2] > 0.1""",
)
def h7_fitted_q_nonlinear(spark, sf_dir):
    """Action values in random features of the state, fitted to all orders; every order with a clear best action gets it."""
    x = F.col("o_totalprice").cast("double") / 100_000.0
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", x.alias("x"))
    rewards = F.array(*[F.expr(w).cast("double") for w in _WAVES])
    valued = orders.withColumns({"state": F.array("x"), "rewards": rewards, "action": (F.col("o_custkey") % 3).cast("int")})
    seen = valued.select(
        "state", "action", F.col("rewards")[F.col("action")].alias("reward"), F.array(F.lit(0.0)).alias("next_state"), F.lit(True).alias("done")
    )
    q = Q.fitted_random_feature_q(seen, 1, iterations=1, scale=0.5)
    best = F.array_sort("rewards")
    clear = valued.where(best[2] - best[1] > 0.1).withColumn("q", q.values("state"))
    return clear.select("o_orderkey", Q.epsilon_greedy(F.col("q"), 0.0, ["o_orderkey"]).alias("greedy_action"))
