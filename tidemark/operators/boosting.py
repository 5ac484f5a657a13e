"""Boosted-tree training with patience-based early stopping, on MLlib.

MLlib grows the trees; what is kept of them is a plain table of nodes.  Beyond
10,000 rows, where MLlib takes its bins from a sample, they come from all rows here;
rows alike in bins and label are one cell, and the trees of a class are grown as
MLlib grows them in one task, or by MLlib if the cells are very many.  Rows are
scored from that table in Arrow batches, after any number of rounds, so all
classes can be cut at the round of their least joint loss without fitting again.
A feature with missing values is given to the trees twice, missing at either end,
so each split learns to which side missing values go.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column
from tidemark.functions.decisions import argmax
from tidemark.operators.cells import COUNT, Inputs, bin_edges, cells, cut_below, gathered, grow
from tidemark.operators.cells import missing as _missing
from tidemark.operators.cells import rows_of as _rows_of
from tidemark.operators.evaluation import staged_log_loss
from tidemark.session import materialise, scratch_path

# fixed values of the training jobs
MULTICLASS = {"max_depth": 4, "step_size": 0.1, "max_rounds": 100, "patience": 10, "max_bins": 64}
BINARY = {"max_depth": 6, "step_size": 0.3, "max_rounds": 100, "patience": 10, "max_bins": 64}

# the first run of an early-stopped fit lasts this many times the patience
_FIRST_TRY = 3
# concurrent fits of one model; more classes wait
_MOST_FITS = 8
# rows that a task of a training job takes at least
_TASK_ROWS = 20_000
# rows whose losses after every round a task takes at least
_STAGED_ROWS = 5_000
# MLlib takes its bins from all of so many rows, and of the bins' square, else from a sample
_BINNED_WHOLE = 10_000
# inputs of cells that one task grows a class's trees from; MLlib grows them from more
_GATHERED = 8_000_000
# stands for a missing value below or above all others; halves of it can be added
_END = 1e300
_FEATURES = "_features"
_LABEL = "_label"
# entries of a batch's walk through all trees
_WALK = 1 << 17


def best_and_stop(losses: Sequence[float], patience: int) -> tuple[int, int]:
    """0-based best and stopping round of one run's losses (see ``early_stop_round`` for tables)."""
    best = 0
    for step, loss in enumerate(losses):
        if loss < losses[best]:
            best = step
        elif step - best >= patience:
            return best, step
    return best, len(losses) - 1


NODE_SCHEMA = (
    "ensemble int, tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double"
)
_NODE_TYPES = [pa.int32()] * 4 + [pa.float64(), pa.bool_(), pa.int32(), pa.int32(), pa.float64()]
_NODE_NAMES = [part.split()[0] for part in NODE_SCHEMA.split(", ")]


class Trees:
    """Ensembles of equally many trees as arrays over (ensemble, tree, node); leaves have feature -1."""

    def __init__(self, nodes: pa.Table):
        at = tuple(nodes[c].to_numpy() for c in ("ensemble", "tree", "node"))
        shape = tuple(int(i.max()) + 1 if len(i) else 0 for i in at)
        self.nodes, self.arrays = nodes, {}
        for name, missing in (("feature", -1), ("threshold", 0.0), ("missing_left", False), ("left", 0), ("right", 0), ("value", 0.0)):
            values = nodes[name].to_numpy(zero_copy_only=False) if isinstance(nodes[name], pa.Array) else nodes[name].to_numpy()
            table = np.full(shape, missing, values.dtype)
            table[at] = values
            self.arrays[name] = table

    def cut(self, rounds: int) -> Trees:
        return Trees(self.nodes.filter(pa.array(self.nodes["tree"].to_numpy() < rounds)))

    @property
    def rounds(self) -> int:
        return self.arrays["value"].shape[1]

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        """What each tree adds to each row's margin: (row, ensemble, tree); rows hold NaN for missing."""
        ensembles, trees, nodes = self.arrays["value"].shape
        n_trees = ensembles * trees
        if not n_trees:
            return np.zeros((len(rows), ensembles, trees))
        # nodes of all trees in a row; a leaf leads to itself, so all walks have the same number of steps
        base = np.repeat(np.arange(n_trees) * nodes, nodes)
        inner = self.arrays["feature"].ravel() >= 0
        here = np.arange(n_trees * nodes)
        onward = np.stack([np.where(inner, base + self.arrays[side].ravel(), here) for side in ("right", "left")], axis=1).ravel()
        feature = np.maximum(self.arrays["feature"].ravel(), 0).astype(np.int64)
        threshold, missing_left = self.arrays["threshold"].ravel(), self.arrays["missing_left"].ravel()
        steps = self._depth(onward.reshape(-1, 2), np.arange(n_trees) * nodes)
        out = np.empty((len(rows), n_trees))
        size = max(1, _WALK // n_trees)
        for begin in range(0, len(rows), size):
            part = np.ascontiguousarray(rows[begin : begin + size])
            flat, gaps = part.ravel(), bool(np.isnan(part).any())
            first = (np.arange(len(part)) * part.shape[1])[:, None]
            at = np.broadcast_to(np.arange(n_trees) * nodes, (len(part), n_trees))
            for _ in range(steps):
                value = flat.take(first + feature.take(at))
                left = value <= threshold.take(at)
                if gaps:
                    left |= np.isnan(value) & missing_left.take(at)
                at = onward.take(2 * at + left)
            out[begin : begin + size] = self.arrays["value"].ravel().take(at)
        return out.reshape(-1, ensembles, trees)

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that no split tells apart share a cell: the place of one row of each cell, and each row's cell."""
        feature, threshold = self.arrays["feature"].ravel(), self.arrays["threshold"].ravel()
        code = np.zeros(len(rows), np.int64)
        for f in np.unique(feature[feature >= 0]):
            cuts, values = np.unique(threshold[feature == f]), rows[:, f]
            # how many cuts lie below a value decides all its comparisons; a missing one has a place of its own
            place = np.where(np.isnan(values), len(cuts) + 1, np.searchsorted(cuts, values, side="left"))
            code = np.unique(code * (len(cuts) + 2) + place, return_inverse=True)[1]
        _, first, cell = np.unique(code, return_index=True, return_inverse=True)
        return first, cell

    @staticmethod
    def _depth(onward: np.ndarray, roots: np.ndarray) -> int:
        """Steps after which every walk from a root stands in a leaf."""
        depth, level = 0, roots
        while True:
            # only leaves lead to themselves
            level = level[(onward[level] != level[:, None]).any(1)]
            if not len(level):
                return depth
            depth, level = depth + 1, np.unique(onward[level])


def _sigmoid(margins: np.ndarray) -> np.ndarray:
    """The class probability that MLlib's logistic loss gives a margin."""
    return 1 / (1 + np.exp(-2 * np.clip(margins, -350, 350)))


@dataclass(frozen=True, eq=False)
class BoostedModel:
    """One boosted ensemble per class (a single one for two classes), all cut at one round."""

    trees: Trees
    features: tuple[str, ...]
    classes: int
    losses: tuple[float, ...] = ()

    @property
    def rounds(self) -> int:
        return self.trees.rounds

    def _features(self) -> Column:
        return F.array(*[column(f).cast("double") for f in self.features])

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (array over classes, summing to 1) and ``prediction`` (its argmax)."""
        shared, width, classes = df.sparkSession.sparkContext.broadcast(self.trees), len(self.features), self.classes

        @F.arrow_udf("array<double>")
        def probability(batch: pa.Array) -> pa.Array:
            rows = _rows_of(batch, width)
            first, cell = shared.value.cells(rows)
            positive = _sigmoid(shared.value.contributions(rows[first]).sum(2))
            if classes == 2:
                positive = np.concatenate([1 - positive, positive], axis=1)
            # logistic outputs: their sum is above zero
            shares = (positive / positive.sum(1, keepdims=True))[cell]
            ends = pa.array(np.arange(0, shares.size + 1, classes), pa.int32())
            return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(shares).ravel()))

        scored = df.withColumn("probability", probability(self._features()))
        return scored.withColumn("prediction", argmax(F.col("probability")))

    def staged(self, df: DataFrame) -> DataFrame:
        """Add ``margins``: per ensemble the row's margin after each round."""
        shared, width = df.sparkSession.sparkContext.broadcast(self.trees), len(self.features)

        @F.arrow_udf("array<array<double>>")
        def margins(batch: pa.Array) -> pa.Array:
            values = _rows_of(batch, width)
            first, cell = shared.value.cells(values)
            added = shared.value.contributions(values[first]).cumsum(2)[cell]
            rows, ensembles, rounds = added.shape
            inner = pa.array(np.arange(0, added.size + 1, max(rounds, 1)), pa.int32())
            lists = pa.ListArray.from_arrays(inner, pa.array(added.ravel()))
            return pa.ListArray.from_arrays(pa.array(np.arange(0, rows * ensembles + 1, ensembles), pa.int32()), lists)

        return df.withColumn("margins", margins(self._features()))


def _sources(train: DataFrame, features: Sequence[str]) -> tuple[list[tuple[str, float | None]], int]:
    """The trees' inputs: a feature, or one with missing values at the lower and one at the upper end; and the rows."""
    *missing, n_rows = train.agg(*[F.max(_missing(f)).alias(f"_{i}") for i, f in enumerate(features)], F.count("*").alias("_n")).first()
    out: list[tuple[str, float | None]] = []
    for feature, gaps in zip(features, missing, strict=True):
        out += [(feature, -_END), (feature, _END)] if gaps else [(feature, None)]
    return out, n_rows


def _assembled(df: DataFrame, sources: Sequence[tuple[str, float | None]], label: str, count: str | None = None) -> DataFrame:
    def given(feature: str, end: float | None) -> Column:
        value = column(feature).cast("double")
        return value if end is None else F.when(_missing(feature), end).otherwise(value)

    inputs = [given(*s).alias(f"_input_{i}") for i, s in enumerate(sources)]
    assembler = VectorAssembler(inputCols=[f"_input_{i}" for i in range(len(sources))], outputCol=_FEATURES, handleInvalid="error")
    named = df.select(*inputs, column(label).cast("double").alias(_LABEL), (F.lit(1) if count is None else F.col(count)).alias(COUNT))
    return assembler.transform(named).select(_FEATURES, _LABEL, COUNT)


def _nodes(
    model: GBTClassificationModel, index: int, sources: Sequence[tuple[str, float | None]], features: Sequence[str], spark, edges=None
) -> pa.Table:
    """A fitted ensemble's nodes, from the table that MLlib saves; leaf values carry their tree's weight.

    With the ``edges`` of bins, thresholds between two bins are the lower one's end.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    split = F.col("nodeData.split")
    saved = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", split["featureIndex"], F.get(split["leftCategoriesOrThreshold"], F.lit(0)), "nodeData.leftChild", "nodeData.rightChild", "nodeData.prediction"
    )
    places, weights, rows = {f: i for i, f in enumerate(features)}, model.treeWeights, []
    for tree, node, source, threshold, left, right, prediction in saved.collect():
        leaf = left < 0
        feature, end = (None, None) if leaf else sources[source]
        # a missing value stands where its input puts it; without one in training it goes right
        to_left = not leaf and end is not None and end <= threshold
        place = -1 if leaf else places[feature]
        if edges is not None and not leaf:
            threshold = cut_below(threshold, edges[place])
        rows.append((index, tree, node, place, threshold or 0.0, to_left, max(left, 0), max(right, 0), prediction * weights[tree] if leaf else 0.0))
    columns = zip(*rows, strict=True)
    return pa.table({n: pa.array(c, t) for n, c, t in zip(_NODE_NAMES, columns, _NODE_TYPES, strict=True)})


def _grown(
    rows: DataFrame, features: Sequence[str], sources: Sequence[tuple[str, float | None]], edges, targets: Sequence[int], rounds: int, settings: dict
) -> pa.Table:
    """The nodes of all ensembles, grown from cells; one task a class."""
    width, depth, step = len(features), settings["max_depth"], settings["step_size"]
    places = {f: i for i, f in enumerate(features)}
    inputs = [(places[f], end) for f, end in sources]

    def grow_target(batches):
        batches = [b for b in batches if b.num_rows]
        if batches:
            index = batches[0].column("_index")[0].as_py()
            values, labels, counts = gathered(batches, width)
            nodes = grow(Inputs(values, inputs, edges), inputs, counts, labels == targets[index], rounds, depth, step)
            columns = [[index] * len(nodes), *zip(*nodes, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NODE_TYPES, strict=True)], _NODE_NAMES)

    # a Python function's input has no dots in its names
    plain = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
    copies = plain.withColumn("_index", F.explode(F.array(*[F.lit(i) for i in range(len(targets))])))
    return copies.repartitionById(len(targets), F.col("_index")).mapInArrow(grow_target, NODE_SCHEMA).toArrow()


def _train(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    validation: DataFrame | None,
    classes: int,
    settings: dict,
    seed: int,
) -> BoostedModel:
    spark = train.sparkSession
    sources, n_rows = _sources(train, features)
    edges, bins, counted = None, settings["max_bins"], {}
    if n_rows > max(bins**2, _BINNED_WHOLE):
        edges = bin_edges(train, features, bins)
        train = materialise(cells(train, features, edges, label, _LABEL), "cells")
        n_rows, unlabelled = train.agg(F.count("*"), F.max(F.col(_LABEL).isNull() | F.isnan(_LABEL))).first()
        if unlabelled:
            raise ValueError(f"a row to train on has no {label}")
        if validation is not None:
            validation = materialise(cells(validation, features, edges, label, _LABEL), "cells")
            # each cell has a margin for every round: more work than its bytes tell
            validation = validation.repartition(1 + validation.count() // _STAGED_ROWS)
        label, counted = _LABEL, {"count": COUNT}
        # so many bins, of which the cells fill few, make MLlib look at all cells for its splits
        bins = max(bins, math.isqrt(n_rows) + 1)
    gather = edges is not None and n_rows * len(sources) <= _GATHERED
    # every level of every tree is a job over these rows: few rows are few tasks
    tasks = 1 + n_rows // _TASK_ROWS
    given = _assembled(train, sources, label, **counted)
    rows = (given.coalesce(tasks) if edges is None else given.repartition(tasks)).persist(StorageLevel.MEMORY_AND_DISK)
    targets = [1] if classes == 2 else list(range(classes))

    def fitted(rounds: int) -> BoostedModel:
        if gather:
            return BoostedModel(Trees(_grown(train, features, sources, edges, targets, rounds, settings)), tuple(features), classes)

        @inheritable_thread_target(spark)
        def fit_target(numbered: tuple[int, int]) -> pa.Table:
            index, target = numbered
            booster = GBTClassifier(
                featuresCol=_FEATURES,
                labelCol=_LABEL,
                maxDepth=settings["max_depth"],
                stepSize=settings["step_size"],
                maxIter=rounds,
                maxBins=bins,
                checkpointInterval=10,
                seed=seed,
                **({"weightCol": COUNT} if counted else {}),
            )
            model = booster.fit(rows.withColumn(_LABEL, (F.col(_LABEL) == float(target)).cast("double")))
            return _nodes(model, index, sources, features, spark, edges)

        # the ensembles are independent; their jobs share the cluster
        with ThreadPool(min(len(targets), _MOST_FITS)) as pool:
            return BoostedModel(Trees(pa.concat_tables(pool.map(fit_target, list(enumerate(targets))))), tuple(features), classes)

    most, patience = settings["max_rounds"], settings["patience"]
    try:
        if validation is None:
            return fitted(most)
        # a short run that already stalls spares the full one
        for rounds in sorted({min(_FIRST_TRY * patience, most), most}):
            full = fitted(rounds)
            logged = staged_log_loss(full.staged(validation), label, **counted).orderBy("step").collect()
            losses = tuple(r["log_loss"] for r in logged)
            if not losses or losses[0] is None:
                continue
            best, stop = best_and_stop(losses, patience)
            if stop - best >= patience:
                break
    finally:
        rows.unpersist()
    if not losses or losses[0] is None:
        return full
    return BoostedModel(full.trees.cut(best + 1), tuple(features), classes, losses[: stop + 1])


def train_multiclass(
    train: DataFrame,
    features: Sequence[str],
    label: str = "target",
    validation: DataFrame | None = None,
    classes: int | None = None,
    seed: int = 42,
    **overrides,
) -> BoostedModel:
    """One-vs-rest boosted trees over labels 0..k-1 with normalised class scores.

    All classes are cut at the round of the least joint log loss of
    ``validation``.  Pass the test frame to stop on the test set.
    """
    if classes is None:
        classes = int(train.agg(F.max(column(label))).first()[0]) + 1
    return _train(train, features, label, validation, max(classes, 2), {**MULTICLASS, **overrides}, seed)


def train_binary(
    train: DataFrame,
    features: Sequence[str],
    label: str = "target",
    validation: DataFrame | None = None,
    seed: int = 42,
    **overrides,
) -> BoostedModel:
    """Boosted trees over labels 0 and 1, cut at the best validation round."""
    return _train(train, features, label, validation, 2, {**BINARY, **overrides}, seed)
