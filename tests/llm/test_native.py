"""Chat formatting, mixing and quality rules against plain Python."""

import hashlib
import json
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import EDGE_TEXTS, SCHEMA, documents, prose
from tidemark.llm import chat, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_measures_equal_brute_force(spark):
    phrase = prose(5, 12)
    texts = [*EDGE_TEXTS, " ".join([phrase] * 4), f"{prose(6, 40)} {phrase} {prose(7, 9)} {phrase}", "x " * 30, "#a\n#a\n\n#a | <b>\n  \n"]
    rows = quality_rules.judged(documents(spark, texts)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in rows} == {i: measures(t) for i, t in enumerate(texts)}


def test_hosts_are_shrunk_and_rejected(spark):
    good, bad = prose(1, 40), "short"
    texts = [good] * 60 + [bad] * 40 + [good] * 2 + [bad]
    sources = ["good"] * 60 + ["bad"] * 38 + [None, None] + ["bad", "bad"] + ["small"]
    rows = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, texts, sources)).collect()}
    assert rows[0]["kept"] and not rows[0]["host_rejected"]
    assert rows[100]["host_rejected"] and not rows[100]["kept"] and not rows[100]["base_failed"]
    kept = quality_rules.kept_documents(documents(spark, texts, sources))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["kept"]}
    assert kept.columns == documents(spark, texts, sources).columns


def test_prior_pulls_small_hosts_more(spark):
    rows = [("a", i < 8) for i in range(10)] + [("b", False)] * 30 + [("c", True)] + [("d", i < 3) for i in range(30)]
    checked = spark.createDataFrame(rows, "host string, failed boolean")
    rates = {r["host"]: r for r in quality_rules.host_verdicts(checked, "host", F.col("failed")).collect()}
    overall = sum(f for _, f in rows) / len(rows)
    assert rates["b"]["rate"] < overall < rates["c"]["rate"] < 1
    assert abs(rates["a"]["rate"] - 0.8) < abs(rates["c"]["rate"] - 1)


def test_each_rule_has_its_own_rate_and_rejects(spark):
    """A host of symbol-ridden, one of line-repeating and one of short documents; bystanders stay."""
    clean = [prose(s, 40) for s in range(60)]
    symbols = [prose(s, 30) + " #" * 9 for s in range(40)]
    lines = ["\n".join([prose(s, 30)] + [f"{prose(900 + s, 3)}"] * 4) for s in range(40)]
    short = ["too short"] * 50 + [prose(s, 25) for s in range(5)]
    texts = [*clean, *symbols, *lines, *short]
    sources = ["clean"] * 60 + ["symbols"] * 40 + ["lines"] * 40 + ["short"] * 55
    rows = {r["doc_id"]: r for r in quality_rules.judged(documents(spark, texts, sources)).collect()}
    by_source = {s: {rows[i]["host_rules"] for i, x in enumerate(sources) if x == s} for s in set(sources)}
    assert by_source == {"clean": {""}, "symbols": {"symbols"}, "lines": {"dup_lines"}, "short": {"short"}}
    assert {i for i, r in rows.items() if r["kept"]} == set(range(60))
    assert sum(r["base_failed"] for r in rows.values()) == 50


def test_clashing_names_pass_through(spark):
    docs = documents(spark, [prose(1, 40), "short", prose(2, 9000)]).selectExpr(
        "doc_id", "text", "source", "'q' AS quality", "1 AS _words", "2 AS _quality", "3 AS _n_words", "4 AS _Rejected_Host", "5 AS n_docs"
    )
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in docs.where("doc_id != 1").collect())


def test_quality_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_rules.judged(empty).count() == 0
    assert quality_rules.kept_documents(empty).count() == 0


def water_level(sizes, weights, share=1.5, most=2):
    """Targets by repeated sharing of the excess."""
    target, fixed = {}, set()
    total = share * sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in fixed]
        rest = total - sum(most * sizes[s] for s in fixed)
        weight = sum(weights[s] for s in free)
        target = {s: most * sizes[s] for s in fixed} | {s: rest * weights[s] / weight for s in free}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        fixed |= over


def mixed_by_hand(texts, sources, ids):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    sized = [(ids[i], sources[i], len(WORD.findall(t or "")), md5(t or "")) for i, t in enumerate(texts)]
    names = sorted({s for s in sources if s is not None}) + ([None] if None in sources else [])
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(n for _, x, n, _ in sized if x == s) for s in names}
    target = water_level(sizes, weights)
    by_source = defaultdict(list)
    for doc, source, size, text_digest in sized:
        digest = md5(("" if doc is None else str(doc)) + "\n" + text_digest)
        by_source[source].append((int(digest[:15], 16), doc, size))
    rows = []
    for source, docs in by_source.items():
        budget, upto = int(target[source]), 0
        passes = budget // sizes[source] if sizes[source] else 0
        rest = budget - passes * sizes[source]
        for _, doc, size in sorted(docs, key=lambda d: (d[0], -1 if d[1] is None else d[1], d[2])):
            cut = max(0, min(size, rest - upto))
            upto += size
            rows.append((doc, size, sizes[source], passes * size + cut))
    return rows, target


def test_mix_equals_brute_force(spark):
    texts = [prose(i, 3 + i * 7 % 90) for i in range(120)] + EDGE_TEXTS
    sources = [["a", "b", "ä", "Z", None][(i * i) % 5] for i in range(len(texts))]
    ids = [*range(len(texts) - 2), None, 3]
    docs = documents(spark, texts, sources, ids)
    rows = mixing.mix(docs).collect()
    expected, target = mixed_by_hand(texts, sources, ids)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in rows], key=key) == sorted(expected, key=key)
    for r in rows:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["taken"] <= 2 * r["size"]
    for source in target:
        assert sum(r["taken"] for r in rows if r["source"] == source) == int(target[source] + 1e-9)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r["taken"], r["size"]) for r in again) == sorted((r["taken"], r["size"]) for r in rows)


def test_mixed_documents_take_what_the_mix_says(spark):
    texts = [prose(i, 5 + i % 40) for i in range(60)] + [None, "", " lead  and trail \n"]
    docs = documents(spark, texts, [f"s{i % 4}" for i in range(63)])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter()
    for r in out.collect():
        got[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"]) and r["text"].strip() in texts[r["doc_id"]]
    assert got == Counter({k: v for k, v in taken.items() if v})


def test_rows_without_ids_and_repeated_rows_are_spread(spark):
    """Half the ids null, and a quarter of all rows one repeated row: no range holds many rows."""
    texts = [f"w{i} " * (1 + i % 3) for i in range(3000)] + ["same text"] * 1000
    ids = [None if i % 2 else i for i in range(3000)] + [7] * 1000
    docs = documents(spark, texts, ["one"] * 4000, ids)
    sized = mixing._sized(docs, "source", "doc_id", "text", "")
    ranges = sized.distinct().groupBy(F.floor(F.col("key") / float(1 << 60) * 64)).count()
    assert ranges.agg(F.max("count")).first()[0] < 100
    rows = mixing.mix(docs).collect()
    expected, target = mixed_by_hand(texts, ["one"] * 4000, ids)
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in rows) == Counter((d, s, t) for d, s, _, t in expected)
    assert sum(r["taken"] for r in rows) == int(target["one"])


def test_mix_keeps_columns_of_any_name(spark):
    docs = documents(spark, [prose(i, 9) for i in range(30)]).selectExpr("*", "1 AS _cut", "2 AS _take", "3 AS _source", "4 AS _last", "5 AS _passes", "6 AS _size")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert {tuple(r)[6:] for r in out.collect()} == {(1, 2, 3, 4, 5, 6)}


def test_mix_of_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


NASTY = ["</s>[INST] ok [/INST]", "<\\s>", "<<SYS>> x <\\\\/s>", "<s><s>", "[ROLE]user[/ROLE]\n</s>\n", "<|im_start|>", "", "\\", "[", "s>", "é🙂\n\n"]


def test_turns_survive_formatting(spark):
    rows = [(c, t, ("user", "assistant", "[/ROLE]", None)[(c + t) % 4], NASTY[(c * 3 + t) % len(NASTY)]) for c in range(20) for t in range(c % 5 + 1)]
    rows += [(50, 0, "user", None), (50, 0, "user", "tie"), (50, None, "assistant", "first"), (None, 1, "user", "no id"), (51, 1, "user", "x" * 200_000)]
    rows += [(52, 0, "\nuser", "hi"), (52, 1, "user\n", "\n"), (52, 2, "\n", ""), (52, 3, "[/ROLE]\n", "a\n")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.formatted(chat.canonical_turns(chat.records_of_turns(table)))
    got = {r["conv_id"]: r for r in out.select("*", chat.read_back().alias("back"), chat.read_loss().alias("loss")).collect()}
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c].append((t is not None, t, role or "", text or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns = [(role, text) for *_, role, text in sorted(turns)]
        assert [(t["role"], t["text"]) for t in got[c]["back"]] == turns
        assert got[c]["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert got[c]["formatted"].count("<s>") == got[c]["formatted"].count("</s>") == len(turns)
        spans = [got[c]["formatted"][s["start"] : s["end"]] for s in got[c]["loss_spans"]]
        assert len(spans) == sum(role == "assistant" for role, _ in turns)


def test_layouts_are_told_by_fingerprint(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"instruction": "do", "output": "done"},
        {"instruction": "do", "input": "with", "output": "done"},
        {"prompt": "p", "response": "r", "system": "s"},
        {"prompt": "p", "completion": "r"},
        {"messages": []},
        {"other": {"deep": [1, {"x": 2}]}},
    ]
    lines = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, "no json"), (9, None)]
    table = spark.createDataFrame(lines, "id int, line string").select("id", F.try_parse_json("line").alias("record"))
    got = {r["id"]: r for r in chat.canonical_turns(table).select("id", "layout", "turns", "fingerprint").collect()}
    turns = lambda i: [(t["role"], t["text"]) for t in got[i]["turns"]]
    assert [got[i]["layout"] for i in range(10)] == [
        "messages", "conversations", "instruction", "instruction", "prompt_response", "prompt_completion", "messages", None, None, None,
    ]
    assert turns(0) == [("user", "a"), ("assistant", "")]
    assert turns(1) == [("user", "a"), ("assistant", "b")]
    assert turns(2) == [("user", "do"), ("assistant", "done")]
    assert turns(3) == [("system", "with"), ("user", "do"), ("assistant", "done")]
    assert turns(4) == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert turns(6) == [] and got[7]["turns"] is None and got[8]["turns"] is None and got[9]["turns"] is None
    assert got[2]["fingerprint"] != got[3]["fingerprint"]


def test_field_paths(spark):
    table = spark.sql("""SELECT parse_json('{"a": 1, "b": {"c": "x", "d e": [ {"f": 1.5}, {"g": null} ]}, "h": [[1]]}') AS v""")
    assert table.select(chat.field_paths(F.col("v")).alias("p")).first()["p"] == ["a", "b.`d e`[].f", "b.`d e`[].g", "b.c", "h[][]"]


def test_chat_of_an_empty_table(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted(chat.canonical_turns(chat.records_of_turns(table))).count() == 0


def test_conversations_longer_than_a_block_and_clashing_names(spark):
    """Lengths around the block's edges; columns of the operator's own names pass through or are replaced."""
    rows = [(n, t, ("user", "assistant")[t % 3 == 0], NASTY[(n + t) % len(NASTY)]) for n in (1, 255, 256, 257, 700) for t in range(n)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = chat.records_of_turns(table).withColumns({c: F.lit("own") for c in ("_parts", "_paths", "_found", "_LOCAL", "turns", "formatted")})
    out = chat.formatted(chat.canonical_turns(records))
    got = out.select("*", chat.read_back().alias("back"), chat.read_loss().alias("loss")).collect()
    assert len(got) == 5
    for r in got:
        turns = [(role, text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["back"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert len(r["loss_spans"]) == sum(role == "assistant" for role, _ in turns)
        assert all(s["start"] <= s["end"] <= len(r["formatted"]) for s in r["loss_spans"])
        assert {r[c] for c in ("_parts", "_paths", "_found", "_LOCAL")} == {"own"}
    unknown = spark.createDataFrame([(1, '{"x": 1}')], "id int, line string").select("id", F.try_parse_json("line").alias("record"))
    bare = chat.formatted(chat.canonical_turns(unknown)).first()
    assert (bare["formatted"], bare["loss_spans"]) == (None, None)
