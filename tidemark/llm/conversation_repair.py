"""Conversation structure repair: cheapest edits as a secondary-sorted stream.

Rows are repartitioned by conversation and sorted by turn inside their
partitions, and every step runs through such a sorted stream, so that no
conversation is ever gathered.  Read backwards, the stream carries the cost of
repairing all that follows from each of four states across Arrow batches; what
it leaves behind per row is one byte, the best edit in each state.  These back
pointers travel with their rows through Spark's external sort, which spills.
Read forwards, the bytes lead to the edits.  Memory of a task does not depend on
the length of a conversation; one conversation passes through one task, as the
order of its edits demands.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Keeping a row
costs 0, giving it the role user or assistant 2, deleting it 3, and inserting an
empty row of user or assistant 2; a truncated row costs 1 more unless deleted.
Blank rows and repetitions must go.  Of equally cheap edits those whose initials
are least in ASCII are taken.

Defined results: a null role or text counts as one space; rows are taken by turn,
null turns first, rows of one turn by role and text; rows with a null
conversation form one conversation; a row is a repetition if an earlier one has
its role and text; a conversation of which all rows are lost has no edits; very
long texts only make their own batch large; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE_CLASS, SPACE_CLASS

# what the kept rows so far end in
START, SYSTEM, USER, ASSISTANT = range(4)
# the state that a row of the wanted role leads to, from each state
_ONWARD = (USER, USER, ASSISTANT, USER)
# the states that a kept row leads to, by the place of its initial in "sua"
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
# edits in ASCII order; a policy byte has two bits of this order per state
EDITS = "DIKR"
_DELETE, _INSERT, _KEEP, _REROLE = range(4)
# costs when no row is left: a started exchange is filled up
_END_COSTS = (0, 2 * INSERT_COST, INSERT_COST, 0)
_LOST = -1
_OTHER_ROLE, _MUST_GO, _TRUNCATED = 3, 4, 8

_ROW = "conv string, place long, kind int, fault string, gap long, illegal boolean, role string, text string"


@lru_cache(1 << 16)
def best_edits(after: tuple[int, ...], kind: int) -> tuple[tuple[int, ...], int]:
    """Costs before a row, from those after it, and the best edit in each state as one byte.

    Only differences of costs matter, so the least is 0: few cases are ever met.
    """
    extra = TRUNCATED_COST if kind & _TRUNCATED else 0

    def priced(state: int, edit: int) -> float:
        if edit == _DELETE:
            return DELETE_COST + after[state]
        if kind & _MUST_GO:
            return np.inf
        if edit == _REROLE:
            return REROLE_COST + extra + after[_ONWARD[state]]
        reached = _KEPT.get((state, kind & 3))
        return np.inf if reached is None else extra + after[reached]

    plain = [min(priced(s, e) for e in (_DELETE, _KEEP, _REROLE)) for s in range(4)]
    # two insertions reach every state that insertions can reach
    costs = plain
    for _ in range(2):
        costs = [min(plain[s], INSERT_COST + costs[_ONWARD[s]]) for s in range(4)]
    policy = 0
    for state in range(4):
        options = [priced(state, e) for e in range(4)]
        options[_INSERT] = INSERT_COST + costs[_ONWARD[state]]
        policy |= options.index(costs[state]) << 2 * state
    return tuple(int(c - min(costs)) for c in costs), policy


def _policies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in backward order with their policy byte."""
    at: tuple[str | None] | None = None
    costs = _END_COSTS
    for frame in batches:
        policies = np.zeros(len(frame), np.int32)
        for i, (conv, kind) in enumerate(zip(frame["conv"].tolist(), frame["kind"].tolist(), strict=True)):
            if (conv,) != at:
                at, costs = (conv,), _END_COSTS
            if kind != _LOST:
                costs, policies[i] = best_edits(costs, kind)
        yield frame.assign(policy=policies)


class _Edits:
    """Edits in order, as rows of one outgoing batch."""

    def __init__(self) -> None:
        self.rows: list[tuple[str | None, int, str, str, int]] = []
        self.at: tuple[str | None] | None = None
        self.state, self.place = START, 0

    def add(self, edit: int, role: str, source: int) -> None:
        self.place += 1
        self.rows.append((self.at[0], self.place, EDITS[edit], role, source))

    def insert(self) -> None:
        self.state = _ONWARD[self.state]
        self.add(_INSERT, _ROLES[self.state], -1)

    def finish(self) -> None:
        """What a conversation at its end still lacks."""
        while self.at is not None and self.state in (SYSTEM, USER):
            self.insert()

    def begin(self, conv: str | None) -> None:
        self.finish()
        self.at, self.state, self.place = (conv,), START, 0

    def take(self, role: str, kind: int, policy: int, source: int) -> None:
        while (edit := policy >> 2 * self.state & 3) == _INSERT:
            self.insert()
        if edit == _KEEP:
            self.state = _KEPT[self.state, kind & 3]
        elif edit == _REROLE:
            self.state = _ONWARD[self.state]
            role = _ROLES[self.state]
        self.add(edit, role, source)

    def frame(self, rows: pd.DataFrame | None) -> pd.DataFrame:
        out = pd.DataFrame(self.rows, columns=["conv", "place", "edit", "role", "source"])
        self.rows = []
        source = out.pop("source").to_numpy(np.int64)
        for name, none in (("text", ""), ("fault", ""), ("gap", 0), ("illegal", False)):
            values = np.full(len(source), none, object if isinstance(none, str) else type(none))
            if rows is not None:
                own = source >= 0
                values[own] = rows[name].to_numpy()[source[own]]
            out[name] = values
        return out


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in forward order with their policy bytes become edits."""
    edits = _Edits()
    for frame in batches:
        columns = (frame[c].tolist() for c in ("conv", "role", "kind", "policy"))
        for i, (conv, role, kind, policy) in enumerate(zip(*columns, strict=True)):
            if (conv,) != edits.at:
                edits.begin(conv)
            if kind == _LOST:
                # a mark that the conversation was there
                edits.rows.append((conv, 0, "", "", -1))
            else:
                edits.take(role, kind, policy, i)
        yield edits.frame(frame)
    edits.finish()
    yield edits.frame(None)


def _marked(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, lost: Column | None) -> DataFrame:
    """Rows of one conversation together, with their place, first fault and kind; one shuffle."""
    named = rows.select(
        F.col(conv_id).cast("string").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        F.coalesce(lost if lost is not None else F.lit(False), F.lit(False)).alias("lost"),
    ).repartition("conv")
    by_turn = F.col("turn").asc_nulls_first()
    copy = F.row_number().over(W.partitionBy("conv", "lost", "role", "text").orderBy(by_turn))
    in_order = W.partitionBy("conv").orderBy("lost", by_turn, "role", "text", "copy")
    before, initial = F.lag("turn").over(in_order), F.substr("role", F.lit(1), F.lit(1))
    pair = F.concat(F.lag(initial).over(in_order), initial)
    counted = named.withColumn("copy", copy).select(
        "*",
        F.row_number().over(in_order).cast("long").alias("place"),
        F.when(~F.col("lost") & before.isNotNull() & (F.col("turn") > before), F.col("turn") - before - 1).otherwise(0).cast("long").alias("gap"),
        F.coalesce(~F.col("lost") & ~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
    )
    fault = (
        F.when(~F.col("text").rlike(NOT_SPACE_CLASS), "blank")
        .when(F.col("copy") > 1, "duplicate")
        .when(~F.col("text").rlike(rf"[.!?]{SPACE_CLASS}*\z"), "truncated")
        .otherwise("")
    )
    place_of_initial = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(_OTHER_ROLE)
    kind = (
        place_of_initial
        + F.when(F.col("fault").isin("blank", "duplicate"), _MUST_GO).otherwise(0)
        + F.when(F.col("fault") == "truncated", _TRUNCATED).otherwise(0)
    )
    marked = counted.withColumn("fault", fault).withColumn("kind", F.when(F.col("lost"), _LOST).otherwise(kind).cast("int"))
    return marked.select("conv", "place", "kind", "fault", "gap", "illegal", "role", "text")


def edits(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", lost: Column | None = None
) -> DataFrame:
    """All edits, those of a conversation in order inside one partition.

    Per edit: conv_id, place (from 1), edit (K, R, D or I), the row's role and
    text after it, its first fault, the turns missing before it, and whether the
    row before it has a role that cannot be followed by its own.  Rows for which
    ``lost`` holds only make their conversation known; they come as edits named
    by an empty text.
    """
    backward = _marked(rows, conv_id, turn, role, text, lost).sortWithinPartitions("conv", F.col("place").desc())
    forward = backward.mapInPandas(_policies, f"{_ROW}, policy int").sortWithinPartitions("conv", "place")
    found = forward.mapInPandas(
        _walk, "conv string, place long, edit string, role string, text string, fault string, gap long, illegal boolean"
    )
    return found.select(F.col("conv").cast(rows.schema[conv_id].dataType).alias(conv_id), *found.columns[1:])


def repaired(rows: DataFrame, conv_id: str = "conv_id", **named: str) -> DataFrame:
    """The repaired conversations as rows: conv_id, place in the conversation, role, text, edit."""
    kept = edits(rows, conv_id, **named).where(F.col("edit").isin("K", "R", "I"))
    return kept.select(conv_id, "place", "role", "text", "edit")


class _Account:
    """Running figures of one conversation."""

    def __init__(self, conv: str | None):
        self.conv, self.gaps, self.illegal, self.cost = conv, 0, 0, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit, self.digest, self.first = bytearray(), hashlib.sha256(), True

    def add(self, edit: str, role: str, text: str, fault: str, gap: int, illegal: bool) -> None:
        self.gaps += gap
        self.illegal += illegal
        if fault:
            self.faults[fault] += 1
        self.audit += edit.encode()
        self.cost += {"D": DELETE_COST, "I": INSERT_COST, "R": REROLE_COST}.get(edit, 0)
        if edit in ("K", "R"):
            self.cost += TRUNCATED_COST if fault == "truncated" else 0
        if edit in ("K", "R", "I"):
            self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False

    def row(self) -> tuple:
        return (self.conv, self.gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest())


def _accounts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    account: _Account | None = None
    for frame in batches:
        done = []
        columns = [frame[c].tolist() for c in ("edit", "role", "text", "fault", "gap", "illegal")]
        for conv, *edit in zip(frame["conv"].tolist(), *columns, strict=True):
            if account is None or account.conv != conv:
                done += [account.row()] if account else []
                account = _Account(conv)
            if edit[0]:
                account.add(*edit)
        yield pd.DataFrame(done, columns=names)
    if account:
        yield pd.DataFrame([account.row()], columns=names)


def accounts(found: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Per conversation the figures of ``edits``: gaps, faults, illegal neighbours, cost, audit, digest of the repaired rows.

    Reads the stream of ``edits`` as it is, in order and without a shuffle.
    """
    of_type = found.schema[conv_id].dataType
    summed = found.withColumn("conv", F.col(conv_id).cast("string")).drop(conv_id).mapInPandas(
        _accounts,
        "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )
    return summed.select(F.col("conv").cast(of_type).alias(conv_id), *summed.columns[1:])


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversation rows with planted faults, and the column that marks lost ones.

    By crc32 of ``conv_id:turn`` modulo 20: 0 loses the row, 1 empties its text, 2
    takes out its ``.!?``, 3 repeats it, 4 makes it the user's.  Nulls count as
    one space.
    """
    space = F.lit(" ")
    named = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])) % 20).alias("_fault"),
    )
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = named.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("lost"),
        F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("_copy"),
    )
    return changed.drop("_copy"), F.col("lost")
