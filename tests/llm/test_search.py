"""Exact top-k and near-duplicates against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import EDGE_TEXTS, SCHEMA, documents, prose
from tidemark.llm import near_dup, topk


def _vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(0, 0.2, 8)], "x") for i in range(n)]
    rows += [(n, None, "x"), (n + 1, [1.0, None], "x"), (n + 2, [float("nan")] * 8, "x"), (n + 3, [math.inf] * 8, "x"), (None, [1.0] * 8, "x")]
    return rows + [(7, rows[7][1], "x"), (n + 4, rows[3][1], "x"), (n + 5, [2.0], "x"), (n + 6, [], "x")]


def _brute_top(rows, k, modulus):
    points = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for query_id, query in {(i, tuple(v)) for i, v in points if i % modulus == 0}:
        scores = sorted((-sum(a * b for a, b in zip(query, v, strict=False)), i) for i, v in points if i != query_id)
        out |= {(query_id, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("shard_rows,block", [(10_000, 1_000), (40, 10)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    rows = _vectors(300)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string").repartition(3)
    got = topk.top_k(table, F.col("vec_id") % 7 == 0, 5, shard_rows=shard_rows, block_queries=block).collect()
    assert {tuple(r) for r in got} == _brute_top(rows, 5, 7)


def test_top_k_of_few_rows(spark):
    table = spark.createDataFrame(_vectors(3)[:3], "vec_id long, embedding array<double>, score string")
    assert {tuple(r) for r in topk.top_k(table, F.col("vec_id") == 0, 5).collect()} == {t for t in _brute_top(_vectors(3)[:3], 5, 50)}
    assert topk.top_k(table.limit(0), F.col("vec_id") == 0, 5).count() == 0


def test_half_the_rows_alike_and_large_components(spark):
    """Copies of a row share no shard beyond k; scores beyond 2^53 are whole."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-4_000_000, 4_000_000, 6)], "x") for i in range(200)] + [(3, [2.0e6] * 6, "x")] * 200
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, 7, shard_rows=30).collect()]
    assert sorted(got) == sorted(_brute_list(rows, 7, 50))
    huge = spark.createDataFrame([(0, [3.0e7] * 8, "x"), (1, [3.0e15] * 8, "x")], table.schema)
    with pytest.raises(Exception, match="exceed 64 bits"):
        topk.top_k(huge, F.col("vec_id") == 0, 5).collect()


def _brute_list(rows, k, modulus):
    points = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows]
    out = []
    for query_id, query in {(i, tuple(v)) for i, v in points if i % modulus == 0}:
        scores = sorted((-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in points if i != query_id)
        out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


def test_tree_prunes():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 1, (400, 4)).round() for c in (-60, 0, 60)])
    tree = topk.BallTree(points)
    found = tree.search(np.array([5.0, 5, 5, 5]), np.arange(len(points)), -1, 3, -np.inf)
    best = sorted(((int(points[i] @ [5, 5, 5, 5]), -i) for i in range(len(points))), reverse=True)[:3]
    assert found == [(s, -i) for s, i in best]
    assert tree.search(np.array([5.0, 5, 5, 5]), np.arange(len(points)), -1, 3, 1e9) == []


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def _brute_components(ids, texts, n, percent):
    sets = [_shingles(t, n) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same_id = ids[i] == ids[j] and sets[i] and sets[j]
            if ids[i] is not None and ids[j] is not None and (same_id or (both and 100 * both >= percent * len(sets[i] | sets[j]))):
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted(((ids[i] is not None, ids[i], len(sets[i]), least.get(root(i))) for i in range(len(texts))), key=str)


def _copies(seed, words, n, edits):
    rng = random.Random(seed)
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(1000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("n,percent,rows", [(3, 85, 3), (5, 80, 2)])
def test_components_equal_brute_force(spark, n, percent, rows):
    texts = [*EDGE_TEXTS, *_copies(1, 120, 40, 4), *_copies(2, 80, 25, 6), *(prose(1000 + i, 60) for i in range(30))]
    shared = prose(77, 60)
    texts += [f"{shared} {prose(2000 + i, 20 + i)}" for i in range(25)] + [texts[12], texts[12], "One", "ONE two"]
    ids = [3 * i % 1009 for i in range(len(texts))]
    ids[2], ids[-1], ids[-5] = None, ids[-2], ids[15]
    docs = documents(spark, texts, ids=ids)
    got = near_dup.near_duplicates(docs, shingle_words=n, percent=percent, rows=rows).collect()
    found = sorted(((r["doc_id"] is not None, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)
    assert found == _brute_components(ids, texts, n, percent)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)
    kept = near_dup.kept_documents(docs, shingle_words=n, percent=percent, rows=rows)
    assert kept.columns == docs.columns
    names = [r["doc_id"] for r in kept.collect()]
    assert sorted(n for n in names if n is not None) == sorted({r["doc_id"] for r in got if r["kept"] and r["doc_id"] is not None})


def test_an_id_with_another_text_keeps_its_links(spark):
    # the other text's class is named by id 1, which shares no bucket
    text, other = prose(21, 60), prose(22, 300)
    texts, ids = [text, f"{text} end", other, other], [50, 60, 50, 1]
    got = near_dup.near_duplicates(documents(spark, texts, ids=ids)).collect()
    found = sorted(((True, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)
    assert found == _brute_components(ids, texts, near_dup.SHINGLE_WORDS, near_dup.SIMILAR_PERCENT)


def test_near_duplicates_of_small_tables(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = near_dup.near_duplicates(documents(spark, [None, "", "alone here"])).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 0, 0, True), (1, 0, 1, True), (2, 1, 2, True)]


def test_waves_reach_every_pair(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CENTRAL", 2)
    monkeypatch.setattr(near_dup, "RARE", 3)
    texts = _copies(5, 60, 60, 5)
    got = near_dup.near_duplicates(documents(spark, texts), shingle_words=3, percent=85).collect()
    found = sorted(((True, r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)
    assert found == _brute_components(list(range(len(texts))), texts, 3, 85)


def test_tensoring_saves_minhashes():
    halves = near_dup.halves_for(85, 3)
    assert (1 - (1 - 0.85**3) ** halves) ** 2 >= near_dup.LEAST_RECALL
    assert 2 * halves * 3 < halves * halves * 6 / 5


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["component"] for r in near_dup.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[101] == 100
