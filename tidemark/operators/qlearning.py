"""Q-learning data operators: replay batches, Bellman targets, policies, fitted Q-iteration."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.decisions import argmax, replace_element
from tidemark.operators.splits import sample_exact, seeded_hash
from tidemark.session import materialise

# fixed values of the agent
ACTIONS = 3
GAMMA = 0.95
MEMORY = 2_000
BATCH = 32
EPSILON = 1.0
EPSILON_MIN = 0.01
EPSILON_DECAY = 0.995
EPISODES = 10


def replay_window(transitions: DataFrame, order: Sequence[str], size: int = MEMORY) -> DataFrame:
    """Newest ``size`` transitions."""
    return transitions.orderBy(*[F.col(c).desc() for c in order]).limit(size)


def replay_batch(
    transitions: DataFrame, order: Sequence[str], batch: int = BATCH, size: int = MEMORY, seed: int = 42,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Seeded sample of ``batch`` from the newest ``size`` transitions; empty when there are fewer than ``batch``."""
    window = replay_window(transitions, order, size)
    if window.count() < batch:
        return window.limit(0)
    return sample_exact(window, batch, keys=keys or order, seed=seed)


def bellman_target(reward: Column, done: Column, next_values: Column, gamma: float = GAMMA) -> Column:
    """Reward alone at the end, else reward plus the discounted best next value."""
    return F.when(done, reward).otherwise(reward + F.lit(gamma) * F.array_max(next_values))


def with_target(df: DataFrame, values: str = "q", next_values: str = "q_next", gamma: float = GAMMA) -> DataFrame:
    """Add ``target`` and ``q_target`` (``values`` with the taken action's element replaced)."""
    target = bellman_target(F.col("reward"), F.col("done"), F.col(next_values), gamma)
    return df.withColumn("target", target).withColumn(
        "q_target", replace_element(F.col(values), F.col("action"), F.col("target"))
    )


def hash_uniform(seed: int, keys: Sequence[str]) -> Column:
    """Seeded number in [0, 1) from a row key, equal on every run."""
    digits = F.substring(seeded_hash(seed, keys), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**32))


def epsilon_greedy(
    values: Column, epsilon: Column | float, keys: Sequence[str], seed: int = 42, actions: int = ACTIONS
) -> Column:
    """Random action when the first draw is at most epsilon, else the argmax of ``values``."""
    chance, pick = hash_uniform(seed, keys), hash_uniform(seed + 1, keys)
    limit = epsilon if isinstance(epsilon, Column) else F.lit(float(epsilon))
    # with epsilon 0 nothing explores, even on a draw of exactly 0
    explore = (limit > 0) & (chance <= limit)
    return F.when(explore, F.floor(pick * actions).cast("int")).otherwise(argmax(values))


def epsilon_after(
    replays: Column, start: float = EPSILON, decay: float = EPSILON_DECAY, minimum: float = EPSILON_MIN
) -> Column:
    """Epsilon after a number of replays; it decays only while above ``minimum``."""
    if start <= minimum or decay >= 1:
        return F.when(replays.isNotNull(), F.lit(float(start)))
    last = 1 if decay <= 0 or minimum <= 0 else math.ceil(math.log(minimum / start) / math.log(decay))
    if minimum <= 0 < decay:
        return F.lit(start) * F.pow(F.lit(decay), replays)
    return F.lit(start) * F.pow(F.lit(decay), F.least(replays, F.lit(last)))


@dataclass(frozen=True)
class LinearQ:
    """Linear action values: ``weights[a]`` and ``intercepts[a]`` for each action."""

    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]

    def values(self, state: str) -> Column:
        """``array<double>`` of the action values, as plain column arithmetic."""
        per_action = []
        for w, b in zip(self.weights, self.intercepts):
            terms = [F.col(state)[i] * F.lit(float(x)) for i, x in enumerate(w)]
            per_action.append(sum(terms, F.lit(float(b))))
        return F.array(*per_action)


def fitted_q(
    transitions: DataFrame,
    width: int,
    iterations: int = EPISODES,
    actions: int = ACTIONS,
    gamma: float = GAMMA,
    regularisation: float = 1e-6,
) -> LinearQ:
    """Fitted Q-iteration (Ernst et al. 2005) with one linear model per action.

    Each model is a least-squares fit from summed products, so one aggregation
    by action gives all of them and the products of the states are summed only
    once.  The driver receives one small matrix per action, and the weights
    re-enter the plan as literals, so the plan does not grow with the rounds.
    An action never taken keeps zero values.
    """
    frozen = materialise(transitions.select("state", "action", "reward", "next_state", "done"), "transitions")
    inputs = [*[F.col("state")[i] for i in range(width)], F.lit(1.0)]
    per_action = frozen.filter(F.col("action").between(0, actions - 1)).groupBy("action")
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    sums = per_action.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(inputs[i] * inputs[j]).alias(f"s_{i}_{j}") for i, j in pairs]
    ).collect()
    penalty = np.diag([regularisation] * width + [0.0])  # the constant is not penalised
    inverses = {}
    for row in sums:
        moments = np.zeros((width + 1, width + 1))
        for i, j in pairs:
            moments[i, j] = moments[j, i] = row[f"s_{i}_{j}"]
        inverses[row["action"]] = np.linalg.pinv(moments / row["n"] + penalty) / row["n"]
    weights = np.zeros((actions, width + 1))
    for _ in range(iterations):
        q = _linear_q(weights)
        target = bellman_target(F.col("reward"), F.col("done"), q.values("next_state"), gamma)
        products = per_action.agg(*[F.sum(x * target).alias(f"p_{i}") for i, x in enumerate(inputs)])
        for row in products.collect():
            weights[row["action"]] = inverses[row["action"]] @ np.array(row[1:], dtype=float)
    return _linear_q(weights)


def _linear_q(weights: np.ndarray) -> LinearQ:
    return LinearQ(
        tuple(tuple(float(x) for x in row[:-1]) for row in weights), tuple(float(row[-1]) for row in weights)
    )


@dataclass(frozen=True)
class RandomFeatureQ:
    """Action values linear in random cosine features of the state (Rahimi and Recht 2007), which approximate a Gaussian kernel."""

    directions: tuple[tuple[float, ...], ...]
    offsets: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]

    def features(self, states: np.ndarray) -> np.ndarray:
        """One row of features per state, the constant last."""
        waves = np.cos(states @ np.array(self.directions).T + np.array(self.offsets)) * math.sqrt(2 / len(self.offsets))
        return np.column_stack([waves, np.ones(len(states))])

    def of(self, states: np.ndarray) -> np.ndarray:
        """One row of action values per state."""
        return self.features(states) @ np.array(self.weights).T

    def values(self, state: str) -> Column:
        """``array<double>`` of the action values; null for a state with a missing value."""
        width = len(self.directions[0])

        @F.arrow_udf("array<double>")
        def valued(states: pa.Array) -> pa.Array:
            return _listed(self.of(_states(states, width)))

        known = F.col(state).isNotNull() & F.forall(state, lambda x: x.isNotNull() & ~F.isnan(x))
        blank = F.array_repeat(F.lit(0.0), width)
        return F.when(known, valued(F.when(known, F.col(state)).otherwise(blank)))


def _states(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _listed(rows: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(rows).ravel()))


def _block_sums(rows: DataFrame, blocks) -> dict[int, tuple[int, np.ndarray]]:
    """Per action the number of rows and the sum of ``blocks(batch)`` over them.

    ``blocks`` gives a matrix per action of a batch; a task adds its matrices
    up, and one group per action adds those of the tasks, so the driver receives
    one matrix per action.
    """
    schema = "action int, n long, total binary"

    def packed(sums: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "action": pa.array(list(sums), pa.int32()),
                "n": pa.array([n for n, _ in sums.values()], pa.int64()),
                "total": pa.array([m.astype("<f8").tobytes() for _, m in sums.values()], pa.binary()),
            }
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for action, n, matrix in blocks(batch):
                so_far, total = sums.get(action, (0, 0.0))
                sums[action] = so_far + n, total + matrix
        yield packed(sums)

    def together(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, "<f8") for t in table["total"].to_pylist())
        return pa.Table.from_batches([packed({table["action"][0].as_py(): (sum(table["n"].to_pylist()), total)})])

    summed = rows.mapInArrow(task, schema).groupBy("action").applyInArrow(together, schema)
    return {r["action"]: (r["n"], np.frombuffer(r["total"], "<f8")) for r in summed.collect()}


def fitted_random_feature_q(
    transitions: DataFrame,
    width: int,
    features: int = 64,
    scale: float = 1.0,
    iterations: int = EPISODES,
    actions: int = ACTIONS,
    gamma: float = GAMMA,
    regularisation: float = 1e-6,
    seed: int = 42,
) -> RandomFeatureQ:
    """Fitted Q-iteration with action values that need not be linear in the state.

    ``scale`` is the distance of states over which values may change.  The
    products of the features are summed once, those with the targets once per
    round; an action never taken keeps zero values.
    """
    random = np.random.default_rng(seed)
    directions = random.normal(0, 1 / scale, (features, width))
    offsets = random.uniform(0, 2 * math.pi, features)

    def model(weights: np.ndarray) -> RandomFeatureQ:
        return RandomFeatureQ(tuple(map(tuple, directions.tolist())), tuple(offsets.tolist()), tuple(map(tuple, weights.tolist())))

    weights = np.zeros((actions, features + 1))
    q = model(weights)
    known = F.col("action").between(0, actions - 1)
    for state in ("state", "next_state"):
        known &= F.col(state).isNotNull() & F.forall(state, lambda x: x.isNotNull() & ~F.isnan(x))
    frozen = materialise(
        transitions.where(known & F.col("reward").isNotNull()).select("state", F.col("action").cast("int").alias("action"), F.col("reward").cast("double").alias("reward"), "next_state", "done"),
        "transitions",
    )

    def by_action(batch: pa.RecordBatch, made):
        taken = batch.column("action").to_numpy(zero_copy_only=False)
        for action in np.unique(taken):
            part = batch.filter(pa.array(taken == action))
            yield int(action), len(part), made(q.features(_states(part.column("state"), width)), part)

    moments = _block_sums(frozen, lambda batch: by_action(batch, lambda phi, _: phi.T @ phi))
    penalty = np.diag([regularisation] * features + [0.0])
    inverses = {a: np.linalg.pinv(m.reshape(features + 1, -1) / n + penalty, hermitian=True) / n for a, (n, m) in moments.items()}
    for _ in range(iterations):
        current = model(weights)

        def products(phi: np.ndarray, part: pa.RecordBatch, current: RandomFeatureQ = current) -> np.ndarray:
            done = part.column("done").to_numpy(zero_copy_only=False).astype(bool)
            onward = gamma * current.of(_states(part.column("next_state"), width)).max(1)
            return phi.T @ (part.column("reward").to_numpy() + np.where(done, 0.0, onward))

        for action, (_, total) in _block_sums(frozen, lambda batch, made=products: by_action(batch, made)).items():
            weights[action] = inverses[action] @ total
    return model(weights)
