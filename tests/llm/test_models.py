"""Toxicity and quality scores against naive matching and plain loops, over whole tables."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import EDGE_TEXTS, prose
from tidemark.llm import quality_model, toxicity
from tidemark.llm.common import id_share, labelled_sample

SF_DIR = "/root/testdata/sf0.001"


def _naive_matches(folded, model):
    """Every entry and exception looked for at every place."""
    phrases = [f" {' '.join(toxicity.fold(p).split())} " for p in model.exceptions]
    excused = [(at, at + len(p) - 1) for p in phrases for at in range(len(folded)) if folded.startswith(p, at)]
    found = {}
    for entry, weight in model.weights.items():
        if entry in phrases:
            continue
        at = folded.find(entry)
        while at >= 0:
            found[at] = max(found.get(at, weight), weight)
            at = folded.find(entry, at + 1)
    return [w for at, w in found.items() if not any(b <= at < e for b, e in excused)]


def test_toxicity_scores_equal_a_naive_matcher(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", id_share("doc_id", 5) != 0))
    assert model.weights
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(EDGE_TEXTS)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(extra)
    rows = every.select("doc_id", "text", toxicity.scored(F.col("text"), model, spark).alias("score")).collect()
    positive = 0
    for _, text, score in rows:
        folded = toxicity.fold(text or "")
        weight = sum(_naive_matches(folded, model))
        positive += weight > 0
        a = math.log1p(weight) if weight else 0.0
        b = math.log1p(100 * weight / max(1, len(folded.split()))) if weight else 0.0
        logit = model.coefficients[0] + model.coefficients[1] * a + model.coefficients[2] * b
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, logit)))), abs=1e-9)
    assert positive > 3


def _texts():
    return pa.array([*(t or "" for t in EDGE_TEXTS if len(t or "") < 2000), prose(3, 60), "A1 A1 a1 x!", "word " * 9, "é É ß"], pa.large_string())


def test_context_sums_equal_plain_loops():
    places, signs = quality_model.index_vectors()
    found = quality_model._identities(_texts())
    want = np.zeros((2 * quality_model.BUCKETS, quality_model.DIMENSIONS))
    for text in range(len(found.first_word) - 1):
        words = range(found.first_word[text], found.first_word[text + 1])
        for i in words:
            for j in words:
                if i != j and abs(i - j) <= quality_model.REACH:
                    for own in (found.words[i], found.shapes[i]):
                        for near in (found.words[j], found.shapes[j]):
                            for place, sign in zip(places[near], signs[near], strict=True):
                                want[own, place] += sign
    got = quality_model._context_sums(_texts(), places, signs).reshape(want.shape)
    assert np.array_equal(got, want) and want.any()


def test_pooling_equals_plain_loops():
    vectors = np.random.default_rng(2).normal(size=(2 * quality_model.BUCKETS, quality_model.DIMENSIONS)).astype(np.float32)
    texts, found = _texts(), quality_model._identities(_texts())
    got = quality_model.pooled(texts, vectors)
    for text in range(len(texts)):
        first, last = found.first_word[text], found.first_word[text + 1]
        n, size = last - first, len(texts[text].as_py().encode())
        means = [np.mean([vectors[x] for x in kind[first:last]], axis=0) if n else np.zeros(quality_model.DIMENSIONS) for kind in (found.words, found.shapes)]
        hashes = [int(h) for h in found.hashes[first:last]]
        grams = {sum(h << k for k, h in enumerate(hashes[i : i + 4])) % (1 << 64) for i in range(n - 3)}
        counts = [math.log1p(n), math.log1p(size)]
        counts += [len(set(hashes)) / n, len(grams) / (n - 3) if n > 3 else 1, size / n] if n else [0, 0, 0]
        assert got[text] == pytest.approx(np.concatenate([*means, counts]), rel=1e-4, abs=1e-5)


def test_probabilities_equal_plain_loops():
    rng = np.random.default_rng(3)
    width, hidden = quality_model.N_FEATURES, 5
    layers = (rng.normal(size=(width, hidden)), rng.normal(size=hidden), rng.normal(size=hidden), np.array(0.3))
    vectors = rng.normal(size=(2 * quality_model.BUCKETS, quality_model.DIMENSIONS)).astype(np.float32)
    model = quality_model.QualityModel(vectors, rng.normal(size=width), rng.uniform(0.5, 2, width), layers, 1.7)
    got = quality_model.probabilities(_texts(), model)
    for row, probability in zip(quality_model.pooled(_texts(), vectors), got, strict=True):
        x = [max(-8.0, min(8.0, (float(v) - m) / s)) for v, m, s in zip(row, model.mean, model.scale, strict=True)]
        out = float(layers[3])
        for unit in range(hidden):
            out += max(0.0, sum(v * w for v, w in zip(x, layers[0][:, unit], strict=True)) + layers[1][unit]) * layers[2][unit]
        assert probability == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, out / 1.7)))), abs=1e-6)
