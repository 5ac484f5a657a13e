"""Ranked lexical search against plain loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import EDGE_TEXTS, documents, prose
from tidemark.llm import lexical_search

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text):
    return [t for t in re.split(SEPARATORS, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if t]


def _brute(texts, ids, items, k):
    docs = [(i, _terms(t)) for i, t in zip(ids, texts)]
    docs = [(i, t) for i, t in docs if t]
    n, total = len(docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, terms in docs for t in set(terms))
    out = []
    for item_id, text in set(items):
        scored = []
        for i, terms in docs:
            counts, m = Counter(terms), 75 + 25 * len(terms) * n // total
            score = 0
            for t in _terms(text):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


def _items(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, Score string")


@pytest.mark.parametrize("shard_rows,block_terms,seed_rows", [(8192, 1 << 14, 8192), (16, 1 << 14, 20), (40, 60, 8192)])
def test_ranks_equal_brute_force(spark, monkeypatch, shard_rows, block_terms, seed_rows):
    monkeypatch.setattr(lexical_search, "SEED_ROWS", seed_rows)
    monkeypatch.setattr(lexical_search, "LEAF", 4)
    texts = [*EDGE_TEXTS, "Straße ÄÖ-äö a_b c3", *(prose(s, 5 + s * 7 % 90) for s in range(150)), *[prose(3, 40)] * 30]
    ids = [None, *range(1, len(texts) - 1), 5]
    items = [(i, prose(1000 + i, 25) + " " + prose(i, 6)) for i in range(12)]
    items += [(12, None), (13, "..."), (14, "STRASSE ÄÖ äö b c3 c3"), (None, prose(3, 10)), (3, prose(3, 9)), items[0]]
    table = documents(spark, texts, ids=ids).repartition(3)
    got = lexical_search.ranked(table, _items(spark, items), k=7, shard_rows=shard_rows, block_terms=block_terms).collect()
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == _brute(texts, ids, items, 7)


def test_empty_tables(spark):
    docs, items = documents(spark, [prose(1, 9), None]), _items(spark, [(1, prose(1, 9))])
    assert lexical_search.ranked(docs.limit(0), items).count() == 0
    assert lexical_search.ranked(docs, items.limit(0)).count() == 0
    assert lexical_search.ranked(docs.where("text is null"), items).count() == 0


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_terms_across_pieces(monkeypatch, piece):
    monkeypatch.setattr(lexical_search, "_PIECE", piece)
    for text in ["", "a", " a ", "Ab cD--e\x1cf\x85g é_ü " + "x" * 40 + ".", "\x00a\x7fb" * 9]:
        assert [t.decode() for part in lexical_search.terms_of(text.encode()) for t in part] == _terms(text)


def test_tree_prunes_and_bounds_hold():
    """Rows of two vocabularies: an item of one never looks into the other's leaves."""
    rng = np.random.default_rng(1)
    starts, columns, values = [0], [], []
    for row in range(600):
        terms = rng.choice(200, 20, replace=False) + 200 * (row % 2)
        columns += terms.tolist()
        values += rng.integers(1, 2_000_000_000, 20).tolist()
        starts.append(len(columns))
    tree = lexical_search.SparseBallTree(np.array(starts), np.array(columns), np.array(values), 400, leaf=8)
    asked, counts = np.arange(0, 200, 9), np.ones(23, np.int64)
    dense = np.zeros((600, 400), np.int64)
    for row in range(600):
        dense[row, columns[starts[row] : starts[row + 1]]] = values[starts[row] : starts[row + 1]]
    scores = dense[:, asked].sum(1)
    want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if s > 0))[:5]
    assert tree.search(asked, counts, list(range(600)), 5, 0) == [(-s, i) for s, i in want]
    real = counts.astype(float)
    bounds = real @ tree.centroids[asked] + np.minimum(np.sqrt(23) * tree.radius, real @ tree.axis_radius[asked])
    for (begin, end, left, _), bound in zip(tree.nodes, bounds):
        assert bound * (1 + 1e-9) + 1 >= scores[tree.order[begin:end]].max()
    leaves = np.array([left < 0 for _, _, left, _ in tree.nodes])
    assert (bounds[leaves] < -want[-1][0]).mean() > 0.4
