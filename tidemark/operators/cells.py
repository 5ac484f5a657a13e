"""Fitting boosted trees on every row: rows that share the bins of all features and the label are one cell with a count.

Trees are split between bins only, so a table's cells say all that its rows say.
Bins come from all rows: one per value where these are few, else exact quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import column
from tidemark.operators.ordering import Running, lay_out

COUNT = "_rows"
# a feature's input to the trees: its place, and the end at which its missing values stand
Source = tuple[int, float | None]
# a node's impurity below this share of its squares is rounding
_NOISE = 1e-13


def missing(feature: str) -> Column:
    value = column(feature).cast("double")
    return value.isNull() | F.isnan(value)


def rows_of(batch: pa.Array, width: int) -> np.ndarray:
    """A list column of ``width`` numbers each as a matrix; nulls are NaN."""
    return batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _quantiles(values: DataFrame, bins: int) -> list[float]:
    """The values at which the share of rows passes a multiple of 1 / ``bins``, exact."""
    counts = values.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
    total = values.count()
    running = lay_out(counts, ["_value"]).with_running(_upto=Running("sum", F.col("_n"))).df
    reached, before = (F.floor(n * bins / total) for n in (F.col("_upto"), F.col("_upto") - F.col("_n")))
    return [r[0] for r in running.where(reached > before).select("_value").collect()]


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature the upper ends of its bins, in order; the last is the greatest value (0 if there is none)."""
    rows = df.select(*[F.when(~missing(f), column(f).cast("double")).alias(f"_{i}") for i, f in enumerate(features)])
    names = rows.columns
    found = rows.agg(*[F.approx_count_distinct(n) for n in names], *[F.max(n) for n in names]).first()
    near, tops = found[: len(names)], found[len(names) :]
    # the estimate is good to some percent, so twice the bound decides which values are looked at
    few = [n for n, size in zip(names, near, strict=True) if size <= 2 * bins]
    values = dict(zip(few, rows.agg(*[F.collect_set(n) for n in few]).first() if few else [], strict=True))
    out = []
    for name, top in zip(names, tops, strict=True):
        if top is None:
            out.append(np.zeros(1))
            continue
        if len(values.get(name, range(bins + 1))) <= bins:
            known = np.unique(np.array(values[name]))
            with np.errstate(invalid="ignore"):
                half = known[:-1] / 2 + known[1:] / 2
            ends = np.where(np.isfinite(half), half, known[:-1])
        else:
            ends = np.array(_quantiles(rows.where(F.col(name).isNotNull()).select(F.col(name).alias("_value")), bins))
        out.append(np.append(np.unique(ends[ends < top]), top))
    return out


def cells(df: DataFrame, features: Sequence[str], edges: Sequence[np.ndarray], label: str, name: str) -> DataFrame:
    """The features, each at the upper end of its bin or missing, the label as ``name``, and how many rows are so (``COUNT``)."""
    width = len(features)

    @F.arrow_udf("array<double>")
    def at_ends(batch: pa.Array) -> pa.Array:
        rows = rows_of(batch, width)
        out = np.empty_like(rows)
        for f, ends in enumerate(edges):
            # what lies above all values seen is with the greatest
            place = np.minimum(np.searchsorted(ends, rows[:, f], side="left"), len(ends) - 1)
            out[:, f] = np.where(np.isnan(rows[:, f]), np.nan, ends[place])
        return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, width), pa.int32()), pa.array(out.ravel()))

    given = F.array(*[column(f).cast("double") for f in features])
    placed = df.select(at_ends(given).alias("_cell"), column(label).cast("double").alias(name))
    counted = placed.groupBy("_cell", name).agg(F.count(F.lit(1)).alias(COUNT))
    return counted.select(*[F.get("_cell", F.lit(i)).alias(f) for i, f in enumerate(features)], name, COUNT)


def cut_below(threshold: float, ends: np.ndarray) -> float:
    """The upper end of the bin left of a split between bins; a split off the missing values stays as it is."""
    place = int(np.searchsorted(ends, threshold, side="right"))
    return float(ends[place - 1]) if 0 < place < len(ends) else threshold


class Inputs:
    """Cells as bin numbers per source: missing values are a bin below or above all others."""

    def __init__(self, values: np.ndarray, sources: Sequence[Source], edges: Sequence[np.ndarray]):
        self.codes, self.thresholds, self.missing_left = [], [], []
        for feature, end in sources:
            ends, gone = edges[feature], np.isnan(values[:, feature])
            code = np.searchsorted(ends, values[:, feature], side="left")
            cuts = list(ends[:-1])
            if end is not None and end < 0:
                code, cuts = code + 1, [end / 2, *cuts]
            elif end is not None:
                cuts = [*cuts, end / 2]
            lost = 0 if end is None or end < 0 else len(cuts)
            self.codes.append(np.where(gone, lost, code).astype(np.int32))
            self.thresholds.append(np.array(cuts))
            self.missing_left.append(end is not None and end < 0)


def _best_splits(inputs: Inputs, rows: np.ndarray, slot: np.ndarray, total: np.ndarray, first: np.ndarray, weight: np.ndarray, mass: np.ndarray):
    """Per slot the gain, source and bin of its best split, of equal gains the first; ``total`` and ``first`` are its weight and sum."""
    slots = len(total)
    gain, source, place = np.zeros(slots), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for s, (codes, thresholds) in enumerate(zip(inputs.codes, inputs.thresholds, strict=True)):
        size = len(thresholds) + 1
        if size < 2:
            continue
        key = slot * size + codes[rows]
        left = np.bincount(key, weight, slots * size).reshape(slots, size).cumsum(1)[:, :-1]
        sums = np.bincount(key, mass, slots * size).reshape(slots, size).cumsum(1)[:, :-1]
        right = total[:, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            won = sums**2 / left + (first[:, None] - sums) ** 2 / right - (first**2 / total)[:, None]
        won = np.where((left > 0.5) & (right > 0.5), won, -np.inf)
        best = won.argmax(1)
        better = won[np.arange(slots), best] > gain
        gain[better], source[better], place[better] = won[np.arange(slots), best][better], s, best[better]
    return gain, source, place


def grow(inputs: Inputs, sources: Sequence[Source], weight: np.ndarray, positive: np.ndarray, rounds: int, depth: int, step: float) -> list[tuple]:
    """Boosted regression trees on the logistic loss, as MLlib grows them: rows of (tree, node, feature, threshold, missing_left, left, right, value).

    The first tree fits the labels as -1 and 1, each later one the loss's
    gradient, by least variance; leaves hold the mean, times ``step`` after the first.
    """
    sign, margins, out = np.where(positive, 1.0, -1.0), np.zeros(len(weight)), []
    for tree in range(rounds):
        goal = sign if tree == 0 else 4 * sign / (1 + np.exp(np.clip(2 * sign * margins, -700, 700)))
        scale = 1.0 if tree == 0 else step
        rows, slot, ids, fresh = np.arange(len(weight)), np.zeros(len(weight), np.int64), np.zeros(1, np.int64), 1
        for level in range(depth + 1):
            here, mass = weight[rows], (weight * goal)[rows]
            total, first = np.bincount(slot, here, len(ids)), np.bincount(slot, mass, len(ids))
            leaf, split = first / total * scale, np.zeros(len(ids), bool)
            if level < depth:
                gain, source, place = _best_splits(inputs, rows, slot, total, first, here, mass)
                split = gain > _NOISE * np.bincount(slot, mass * goal[rows], len(ids))
            after = np.full(len(ids), -1)
            after[split] = np.arange(int(split.sum()))
            for k, node in enumerate(ids):
                if split[k]:
                    s, lower = source[k], fresh + 2 * after[k]
                    out.append((tree, int(node), sources[s][0], float(inputs.thresholds[s][place[k]]), inputs.missing_left[s], int(lower), int(lower) + 1, 0.0))
                else:
                    out.append((tree, int(node), -1, 0.0, False, 0, 0, float(leaf[k])))
            done = ~split[slot]
            margins[rows[done]] += leaf[slot[done]]
            rows, slot = rows[~done], slot[~done]
            if not len(rows):
                break
            right = np.zeros(len(rows), bool)
            for s, codes in enumerate(inputs.codes):
                of = source[slot] == s
                right[of] = codes[rows[of]] > place[slot[of]]
            slot = 2 * after[slot] + right
            ids = fresh + np.arange(2 * int(split.sum()))
            fresh += len(ids)
    return out


def gathered(batches: Iterator[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The cells of a partition in a fixed order: values, labels and counts; None without any."""
    table = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
    if table is None:
        return None
    parts = [table.column(i).to_numpy().astype(np.float64) for i in range(width + 2)]
    order = np.lexsort(parts)
    values = np.stack([p[order] for p in parts[:width]], axis=1)
    return values, parts[width][order], parts[width + 1][order]
