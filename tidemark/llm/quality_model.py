"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Every word has two hashed identities, its letters and its shape (runs of small
letters, capitals, digits, signs, and whether it repeats the word before).
Random indexing gives each identity a vector: the sum of the sparse random
index vectors of the identities near it.  A document's vectors are averaged,
joined by a few counts, and go through a network of two layers, trained with
numpy; its probabilities are calibrated by a temperature on rows held back.

Tables have a fixed size.  The model is fitted on a bounded sample of labelled
rows; every row is scored, over its whole text.

Defined results: a null or empty text gets the score of zero vectors; without
both labels in the sample the score is the share of label 1 (0.5 without any
row); repeated rows are scored each; an empty table gives an empty result;
other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, slices, utf8, word_bounds, word_hashes

BUCKETS = 1 << 14
DIMENSIONS = 32
NONZERO = 4
REACH = 2
HIDDEN = 32
EPOCHS = 60
FIT_TASKS = 4
HELD_BACK = 5
SEED = 20
_SLICE = 1 << 20
N_FEATURES = 2 * DIMENSIONS + 5

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every identity's index vector; words first, then shapes."""
    random = np.random.default_rng(SEED)
    places = random.integers(0, DIMENSIONS, (2 * BUCKETS, NONZERO))
    return places, random.choice([-1.0, 1.0], (2 * BUCKETS, NONZERO))


@dataclass
class _Identities:
    words: np.ndarray
    shapes: np.ndarray
    hashes: np.ndarray
    first_word: np.ndarray


def _identities(texts: pa.Array) -> _Identities:
    body, offsets = utf8(texts)
    starts, ends, first_word = word_bounds(_SPACES[body], offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return _Identities(none, none, none.astype(np.uint64), first_word)
    hashes = word_hashes(_LOWER[body], starts, ends)
    classes = _CLASS[body]
    changes = np.ones(len(body), bool)
    changes[1:] = classes[1:] != classes[:-1]
    changes[starts] = True
    run = np.cumsum(changes)
    shape = word_hashes(classes[changes], run[starts] - 1, run[ends - 1])
    repeats = np.zeros(len(starts), bool)
    repeats[1:] = hashes[1:] == hashes[:-1]
    shape = mixed(shape + repeats.astype(np.uint64))
    mask = np.uint64(BUCKETS - 1)
    return _Identities((hashes & mask).astype(np.int64), (shape & mask).astype(np.int64) + BUCKETS, hashes, first_word)


def _context_sums(texts: pa.Array, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of the identities within reach of each identity."""
    found = _identities(texts)
    text_of = np.repeat(np.arange(len(found.first_word) - 1), np.diff(found.first_word))
    total = np.zeros(2 * BUCKETS * DIMENSIONS)
    for step in range(1, REACH + 1):
        together = text_of[step:] == text_of[:-step]
        for own, near in (
            (found.words, found.words), (found.words, found.shapes), (found.shapes, found.words), (found.shapes, found.shapes),
        ):
            left, right = own[:-step][together], near[step:][together]
            for a, b in ((left, right), (own[step:][together], near[:-step][together])):
                cells = (a[:, None] * DIMENSIONS + places[b]).ravel()
                total += np.bincount(cells, signs[b].ravel(), len(total))
    return total


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    temperature: float
    constant: float | None = None


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of features per text: mean word vector, mean shape vector, counts on a logarithmic scale, shares of distinct words and 4-grams."""
    out = [np.zeros((0, N_FEATURES), np.float32)]
    for part in slices(texts, _SLICE):
        found = _identities(part)
        rows = np.zeros((len(part), N_FEATURES), np.float32)
        n_words = np.diff(found.first_word)
        full = np.flatnonzero(n_words)
        begins = found.first_word[:-1][full]
        if len(full):
            sizes = n_words[full][:, None]
            rows[full, :DIMENSIONS] = np.add.reduceat(vectors[found.words], begins, axis=0) / sizes
            rows[full, DIMENSIONS : 2 * DIMENSIONS] = np.add.reduceat(vectors[found.shapes], begins, axis=0) / sizes
        lengths = np.diff(utf8(part)[1])
        rows[:, -5] = np.log1p(n_words)
        rows[:, -4] = np.log1p(lengths)
        h = found.hashes
        grams = h[:-3] + (h[1:-2] << np.uint64(1)) + (h[2:-1] << np.uint64(2)) + (h[3:] << np.uint64(3)) if len(h) > 3 else h[:0]
        for i in full:
            first, n = found.first_word[i], n_words[i]
            rows[i, -3] = len(np.unique(h[first : first + n])) / n
            rows[i, -2] = len(np.unique(grams[first : first + n - 3])) / (n - 3) if n > 3 else 1
            rows[i, -1] = lengths[i] / n
        out.append(rows)
    return np.concatenate(out)


def _forward(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.maximum(0, x @ w1 + b1)
    return hidden, hidden @ w2 + b2


def _trained(x: np.ndarray, y: np.ndarray) -> tuple:
    """Two layers by Adam on the logistic loss with weight decay."""
    random = np.random.default_rng(SEED)
    layers = [
        random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(()),
    ]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for epoch in range(EPOCHS):
        rate = 0.003 * (1 - epoch / EPOCHS) + 1e-4
        order = random.permutation(len(x))
        for begin in range(0, len(x), 64):
            batch = order[begin : begin + 64]
            hidden, logit = _forward(x[batch], layers)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[batch]) / len(batch)
            back = error[:, None] * layers[2] * (hidden > 0)
            gradients = [x[batch].T @ back, back.sum(0), hidden.T @ error, error.sum()]
            step += 1
            for k, g in enumerate(gradients):
                g = g + 1e-3 * layers[k] * (k in (0, 2))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a grid of ratios."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))

    def loss(t: float) -> float:
        z = logits / t
        return float(np.mean(np.logaddexp(0, z) - y * z))

    return float(min(grid, key=loss))


def fit(sample: DataFrame) -> QualityModel:
    """Fit vectors and network on ``sample`` (text, label), a bounded written table.

    A fixed number of tasks counts contexts, each into a table of fixed size;
    the driver gets these tables and one row of features per sampled text.
    """
    places, signs = index_vectors()
    # by turns, not by key: as many tables as tasks, whatever the cluster's partition settings
    spread = sample.repartition(FIT_TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * BUCKETS * DIMENSIONS)
        for batch in batches:
            for part in slices(batch.column(0), _SLICE):
                total += _context_sums(part, places, signs)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    total = np.zeros((2 * BUCKETS, DIMENSIONS))
    for row in spread.select("text").mapInArrow(count, "sums binary").collect():
        total += np.frombuffer(row["sums"], "<f4").reshape(total.shape)
    identity = np.zeros_like(total)
    np.add.at(identity, (np.arange(2 * BUCKETS)[:, None], places), signs)
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    vectors = (unit(total) + unit(identity)).astype(np.float32)
    shared = sample.sparkSession.sparkContext.broadcast(vectors)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pooled(batch.column(0), shared.value)
            yield pa.RecordBatch.from_pydict(
                {"features": pa.array([r.tobytes() for r in rows], pa.binary()), "label": batch.column(1).cast(pa.int32())}
            )

    table = sample.select("text", "label").mapInArrow(measure, "features binary, label int").orderBy("label", "features").toArrow()
    y = table["label"].to_numpy().astype(np.float64)
    x = np.frombuffer(b"".join(table["features"].to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)
    blank = QualityModel(vectors, np.zeros(N_FEATURES), np.ones(N_FEATURES), (), 1.0)
    if len(y) == 0 or y.min() == y.max():
        blank.constant = float(y.mean()) if len(y) else 0.5
        return blank
    blank.mean, blank.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.clip((x - blank.mean) / blank.scale, -8, 8)
    back = np.arange(len(y)) % HELD_BACK == 0
    if y[~back].min() == y[~back].max():
        back[:] = False
    layers = _trained(x[~back], y[~back])
    blank.layers, blank.temperature = layers, _temperature(_forward(x[back], layers)[1], y[back])
    return blank


def probabilities(texts: pa.Array, model: QualityModel) -> np.ndarray:
    rows = pooled(texts, model.vectors)
    if model.constant is not None:
        return np.full(len(rows), model.constant)
    x = np.clip((rows.astype(np.float64) - model.mean) / model.scale, -8, 8)
    logits = _forward(x, model.layers)[1] / model.temperature
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scored(text: Column, model: QualityModel, spark) -> Column:
    """The calibrated probability of label 1 of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(probabilities(texts, shared.value), pa.float64())

    return score(text)
