"""Conversation repair against an exhaustive search for the cheapest edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tidemark.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, Place string, kind string"


def _rows(seed, n_conversations, most_turns):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n_conversations), None]:
        for turn in range(rng.randint(0 if conv else 1, most_turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "unknown", "", None])
            text = rng.choice(["Yes.", "No", "a b!", "Is it?  ", "  ", "", None, "é\n", "Yes.", f"t{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text, "x", "y"))
    return rows


def _damage(rows):
    out, seen = {}, set()
    for conv, turn, role, text, *_ in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        seen.add(conv)
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out.setdefault(conv, []).extend([(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1))
    return {c: sorted(out.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c in seen}


def _faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def _cheapest(rows, faults):
    """The least (cost, audit) over all edit sequences whose result has the wanted initials."""
    queue = [(0, "", 0, "", ())]
    while queue:
        cost, audit, i, initials, told = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, told
        if len(audit) > 2 * len(rows) + 3 or not re.fullmatch("s?(ua)*u?", initials):
            continue
        for role in ("user", "assistant"):
            heapq.heappush(queue, (cost + 2, audit + "I", i, initials + role[0], (*told, f"{role}:")))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(queue, (cost + 3, audit + "D", i + 1, initials, told))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = faults[i] == "truncated"
        if role[:1]:
            heapq.heappush(queue, (cost + more, audit + "K", i + 1, initials + role[0], (*told, f"{role}:{text}")))
        for other in ("user", "assistant"):
            heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, initials + other[0], (*told, f"{other}:{text}")))
    raise AssertionError


def _brute(rows):
    out = set()
    for conv, left in _damage(rows).items():
        faults = _faults(left)
        cost, audit, told = _cheapest(left, faults)
        turns = sorted({t for t, *_ in left if t is not None})
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(left, left[1:])]
        figures = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(told).encode()).hexdigest()
        gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
        out.add((conv, gaps, *figures, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return out


def _accounts(table):
    rows, lost = repair.damaged(table)
    return {tuple(r) for r in repair.accounts(repair.edits(rows, lost=lost)).collect()}


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_edits_equal_exhaustive_search(spark, batch):
    """Batches of three rows: state crosses their edges."""
    rows = _rows(5, 120, 6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert _accounts(spark.createDataFrame(rows, SCHEMA).repartition(3)) == _brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert _accounts(spark.createDataFrame([], SCHEMA)) == set()
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_rows_alternate(spark):
    rows = _rows(9, 60, 8)
    turns = repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    by_conv = {}
    for r in sorted(turns, key=lambda r: r["place"]):
        by_conv[r["conv_id"]] = by_conv.get(r["conv_id"], "") + r["role"][0]
    assert by_conv and all(re.fullmatch("(s?(ua)+)?", initials) for initials in by_conv.values())


def test_one_conversation_of_many_rows_and_long_texts(spark):
    n = 30_000
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t}.", "", "") for t in range(n)]
    rows += [(2, 0, "user", "word " * 200_000 + ".", "", ""), (2, 1, "assistant", "x" * 1_000_000, "", "")]
    got = {r["conv_id"]: r for r in repair.accounts(repair.edits(spark.createDataFrame(rows, SCHEMA))).collect()}
    told = "\n".join(f"{role}:{text}" for _, _, role, text, *_ in rows[:n])
    assert (got[1]["cost"], got[1]["audit"]) == (0, "K" * n)
    assert got[1]["repaired_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert (got[2]["cost"], got[2]["audit"], got[2]["truncated"]) == (1, "KK", 1)


def test_few_different_steps_are_met():
    rng, costs, met = random.Random(1), (0, 4, 2, 0), set()
    for _ in range(50_000):
        costs, _ = repair.best_edits(costs, rng.randrange(4) + rng.choice([0, 4, 8]))
        met.add(costs)
    assert len(met) < 100
