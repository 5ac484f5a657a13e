"""Rows that no split tells apart are walked through the trees once; samples to fit on are drawn once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators.boosting import NODE_SCHEMA, Trees
from tidemark.plans.queries_models import FIT_ROWS, _fit_rows


def stumps(splits):
    """One tree of one split each: (ensemble, tree, feature, threshold, missing goes left)."""
    rows = []
    for ensemble, tree, feature, threshold, missing in splits:
        rows.append((ensemble, tree, 0, feature, threshold, missing, 1, 2, 0.0))
        rows += [(ensemble, tree, node, -1, 0.0, False, 0, 0, 10.0 * tree + node + 0.1) for node in (1, 2)]
    return Trees(pa.table(dict(zip([c.split()[0] for c in NODE_SCHEMA.split(", ")], map(pa.array, zip(*rows, strict=True)), strict=True))))


@pytest.mark.parametrize("seed", [1, 2])
def test_cells_score_as_their_rows_do(seed):
    rng = np.random.default_rng(seed)
    cuts = [-np.inf, -1.0, 0.0, 0.5, 2.0, np.inf]
    trees = stumps([(e, t, int(rng.integers(3)), float(rng.choice(cuts)), bool(rng.integers(2))) for e in range(2) for t in range(9)])
    rows = rng.choice([*cuts, -0.0, 0.3, 7.0, np.nan], (500, 4))
    first, cell = trees.cells(rows)
    assert (trees.contributions(rows[first])[cell] == trees.contributions(rows)).all()
    # the unused feature tells no rows apart
    assert len(first) < len(np.unique(rows, axis=0))


def test_few_splits_are_few_cells():
    trees = stumps([(0, t, 1, [17.0, 34.0][t % 2], False) for t in range(40)])
    first, cell = trees.cells(np.random.default_rng(3).uniform(0, 50, (10_000, 2)))
    assert len(first) == 3 and len(cell) == 10_000
    first, cell = trees.cells(np.empty((0, 2)))
    assert trees.contributions(np.empty((0, 2))[first])[cell].shape == (0, 1, 40)


@pytest.mark.parametrize("rows", [50, FIT_ROWS + 50])
def test_fit_rows_are_drawn_once(spark, rows):
    frame = spark.range(rows).select("id", F.xxhash64("id").alias("x"))
    fit = _fit_rows(frame, ["id"])
    assert fit.count() == min(rows, FIT_ROWS) and all("/fit-rows-" in f for f in fit.inputFiles()) and fit.inputFiles()
