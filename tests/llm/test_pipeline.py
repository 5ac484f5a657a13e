"""The pipeline's stages against plain Python on a small fixture, and its registration."""

import re

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import documents, prose
from tests.llm.test_native import measures, mixed_by_hand
from tests.llm.test_search import _brute_components, _copies
from tidemark.llm import secret_scan


def test_stages(spark, tmp_path):
    texts = [*_copies(1, 90, 12, 3), *(prose(50 + i, 25 + i) for i in range(20)), "too short", None, 'x password = "hunter2222" ' + prose(9, 30)]
    texts.append(" ".join([prose(3, 10)] * 6))
    path = str(tmp_path / "documents.parquet")
    documents(spark, texts).write.parquet(path)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "packing"]
    docs = spark.read.parquet(path)
    outs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{i}"))
        columns, docs = docs.columns, spark.read.parquet(str(tmp_path / f"out{i}"))
        assert i == 4 or docs.columns == columns
        outs.append(docs.collect())
    passed = [i for i, t in enumerate(texts) if not measures(t)[-1]]
    assert sorted(r["doc_id"] for r in outs[0]) == passed
    groups = _brute_components(passed, [texts[i] for i in passed], 5, 80)
    unique = sorted(r[1] for r in groups if r[1] == r[3])
    assert sorted(r["doc_id"] for r in outs[1]) == unique
    clean = {r["doc_id"]: r["text"] for r in outs[2]}
    assert clean == {i: secret_scan.redact(texts[i]) for i in unique}
    rows, _ = mixed_by_hand([clean[i] for i in unique], [f"s{i % 3}" for i in unique], unique)
    taken = {doc: 0 for doc in unique}
    for r in outs[3]:
        taken[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert taken == {doc: n for doc, _, _, n in rows}
    mixed = sorted((r["doc_id"], r["text"]) for r in outs[3])
    assert {r["doc_id"] for r in outs[4]} == {doc for doc, _ in mixed}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.agg({"length": "sum"}).first()[0] == sum(r["length"] for r in outs[4])


def test_all_operators_are_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
