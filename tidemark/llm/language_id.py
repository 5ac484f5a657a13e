"""Language identification: scripts narrow candidates, Viterbi labels spans.

Per word, letter trigrams are scored against each language learned.  The
script of a word's letters narrows the candidates to languages written in it.
Viterbi with a penalty for switching then labels the words, so a text in
several languages falls into spans.

The model is hashed trigram counts, a table whose size depends on the number of
languages only.  It is fitted on a bounded sample of labelled rows
(``fit_rows``), and learns the languages that at least one in ``1 /
LEAST_LANGUAGE_SHARE`` of them has, so their number is bounded too; every row is
scored, over its whole text.

Defined results: a null text, or one without letters (marks alone are none), is
``und`` with score 0; without any labelled row every text is; equal totals go to
the language first in order; repeated rows are labelled each; an empty table
gives an empty result; very long texts are scored a stretch of words at a time;
other columns pass through untouched, also one named as the result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, fresh, mixed

UNKNOWN = "und"
FIT_ROWS = 20_000
BUCKETS = 1 << 16
# counts that the background adds to each language
SMOOTHING = 200.0
MOST_EVIDENCE = 6.0
SWITCH_PENALTY = 8.0
# a language is a candidate for a script that makes up this share of its letters
LEAST_SCRIPT_SHARE = 0.02
NO_CANDIDATE = -30.0
LEAST_LANGUAGE_SHARE = 0.005
_SLICE = 1 << 20
# words whose evidence is summed at once
_STRETCH = 1 << 16

# fixed values: script ranges of the Unicode standard, first and last code point
SCRIPTS = {
    "Latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "Armenian": ((0x530, 0x58F),),
    "Hebrew": ((0x590, 0x5FF),),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "Devanagari": ((0x900, 0x97F),),
    "Bengali": ((0x980, 0x9FF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Georgian": ((0x10A0, 0x10FF),),
    "Hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "Kana": ((0x3040, 0x30FF),),
    "Han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}


@cache
def _letters() -> np.ndarray:
    """For each code point 0 if it is no letter or mark of one, else 1 + its script's number, the last for other scripts."""
    table = np.zeros(0x110000, np.uint8)
    scripts = np.full(0x110000, len(SCRIPTS) + 1, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            scripts[first : last + 1] = number
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] in "LM":
            table[code] = scripts[code]
    return table


@cache
def _is_letter() -> np.ndarray:
    return np.frombuffer(bytes(unicodedata.category(chr(code))[0] == "L" for code in range(0x110000)), np.bool_)


def _without_mere_marks(codes: np.ndarray, script: np.ndarray) -> np.ndarray:
    """``script`` with 0 for runs of marks that belong to no letter."""
    runs = np.diff(np.concatenate([[0], script > 0, [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1)
    letters = np.concatenate([[0], np.cumsum(_is_letter()[codes])])
    mere = letters[ends] == letters[starts]
    if not mere.any():
        return script
    script = script.copy()
    for start, end in zip(starts[mere], ends[mere], strict=True):
        script[start:end] = 0
    return script


def _lower(text: str) -> str:
    """Lower case with as many characters as ``text``."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


@dataclass
class _Words:
    """Words of some texts: places in the joined text, texts they are in, scripts, trigram buckets."""

    starts: np.ndarray
    ends: np.ndarray
    first_word: np.ndarray
    text_starts: np.ndarray
    scripts: np.ndarray
    buckets: np.ndarray
    first_bucket: np.ndarray


def _words(texts: list[str]) -> _Words:
    joined = "\n".join(_lower(t) for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + 1 for t in texts])
    text_starts = np.concatenate([[0], np.cumsum(lengths)])
    script = _without_mere_marks(codes, _letters()[codes])
    padded = np.concatenate([[0], script > 0, [0]]).astype(np.int8)
    edges = np.diff(padded)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    inside = script > 0
    around = np.concatenate([[0], np.where(inside, codes, 0), [0]]).astype(np.uint64)
    grams = (around[:-2] << np.uint64(42)) ^ (around[1:-1] << np.uint64(21)) ^ around[2:]
    buckets = (mixed(grams[inside]) & np.uint64(BUCKETS - 1)).astype(np.int32)
    lengths_of = ends - starts
    first_bucket = np.concatenate([[0], np.cumsum(lengths_of)])
    first_word = np.searchsorted(starts, text_starts)
    return _Words(starts, ends, first_word, text_starts, script[starts], buckets, first_bucket)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for text in texts:
        if part and held + len(text) > _SLICE:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


@dataclass
class LanguageModel:
    """Languages, evidence per trigram bucket and language, and candidates per script and language."""

    languages: list[str]
    evidence: np.ndarray
    candidates: np.ndarray


def fit(
    docs: DataFrame, learn_from: Column, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS, doc_id: str = "doc_id"
) -> LanguageModel:
    """Learn from the rows where ``learn_from`` holds and text and language are given, about ``fit_rows`` of them.

    Rows are chosen by a hash of id and text, so copies of a text come in or
    stay out each for itself.

    Tasks count trigrams and scripts of their rows; what reaches the driver is
    one count per language and bucket.
    """
    labelled = docs.where(learn_from & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(doc_id), F.col(text)).alias("spot")
    )
    chosen = bounded_sample(labelled, F.col("spot"), fit_rows).drop("spot")
    shares = chosen.groupBy("lang").count()
    least = LEAST_LANGUAGE_SHARE * F.sum("count").over(W.partitionBy())
    common = [r["lang"] for r in shares.withColumn("least", least).where(F.col("count") >= F.col("least")).collect()]
    sample = chosen.where(F.col("lang").isin(common))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            by_language: dict[str, list[str]] = {}
            for one_text, one_lang in zip(batch.column(0), batch.column(1), strict=True):
                by_language.setdefault(one_lang.as_py(), []).append(one_text.as_py())
            for language, texts in by_language.items():
                table = totals.setdefault(language, np.zeros(BUCKETS + len(SCRIPTS) + 2, np.int64))
                for part in _slices(texts):
                    words = _words(part)
                    table[:BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                    sizes = np.diff(words.first_bucket)
                    table[BUCKETS:] += np.bincount(words.scripts, sizes, len(SCRIPTS) + 2).astype(np.int64)
        for language, table in totals.items():
            slots = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([language] * len(slots), pa.string()), "slot": slots.astype(np.int32), "n": table[slots]}
            )

    counted = sample.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    place = {language: i for i, language in enumerate(languages)}
    counts = np.zeros((BUCKETS + len(SCRIPTS) + 2, len(languages)))
    which = np.array([place[language] for language in rows["lang"].to_pylist()], int)
    counts[rows["slot"].to_numpy(), which] = rows["n"].to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    background = (grams / np.maximum(grams.sum(0), 1)).mean(1, keepdims=True) if languages else np.zeros((BUCKETS, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = np.log((grams + SMOOTHING * background) / (grams.sum(0) + SMOOTHING) / background)
    evidence = np.clip(np.nan_to_num(evidence, nan=0.0), -MOST_EVIDENCE, MOST_EVIDENCE).astype(np.float32)
    candidates = scripts / np.maximum(scripts.sum(0), 1) >= LEAST_SCRIPT_SHARE
    candidates[~candidates.any(1)] = True
    return LanguageModel(languages, evidence, candidates)


def viterbi(scores: np.ndarray, first_word: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best label of each word; ``first_word`` has each text's first row in ``scores``, and the count.

    All texts advance together, one word at a time, the longest first.
    """
    n_words = np.diff(first_word)
    order = np.argsort(-n_words, kind="stable")
    begin, n_words = first_word[:-1][order], n_words[order]
    labels = np.zeros(len(scores), np.int16)
    steps = int(n_words[0]) if len(n_words) else 0
    if not steps:
        return labels
    active = np.searchsorted(-n_words, -np.arange(1, steps + 1), "right")
    came_from = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    value = scores[begin[: active[0]]].astype(np.float64)
    final = np.zeros(len(begin), np.int16)
    for step in range(1, steps):
        if active[step] < active[step - 1]:
            final[active[step] : active[step - 1]] = value[active[step] :].argmax(1)
            value = value[: active[step]]
        best = value.argmax(1)
        switched = value[np.arange(len(value)), best][:, None] - penalty
        at = begin[: len(value)] + step
        switch = switched > value
        came_from[at] = np.where(switch, best[:, None], own)
        value = np.where(switch, switched, value) + scores[at]
    final[: len(value)] = value.argmax(1)
    label = final.copy()
    for step in range(steps - 1, -1, -1):
        at = begin[: active[step]] + step
        labels[at] = label[: active[step]]
        if step:
            label[: active[step]] = came_from[at, label[: active[step]]]
    return labels


def label_texts(texts: list[str], model: LanguageModel, penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, list]]:
    """Language, score and spans (start, end, language) of each text."""
    out: list[tuple[str, float, list]] = []
    if not model.languages:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    for part in _slices(texts):
        words = _words(part)
        scores = np.zeros((len(words.starts), len(model.languages)), np.float32)
        for begin in range(0, len(scores), _STRETCH):
            end = min(begin + _STRETCH, len(scores))
            first, last = words.first_bucket[begin], words.first_bucket[end]
            np.add.reduceat(model.evidence[words.buckets[first:last]], words.first_bucket[begin:end] - first, axis=0, out=scores[begin:end])
        if len(scores):
            scores += np.where(model.candidates[words.scripts], 0, NO_CANDIDATE).astype(np.float32)
        labels = viterbi(scores, words.first_word, penalty)
        letters = words.ends - words.starts
        for text in range(len(part)):
            first, last = words.first_word[text], words.first_word[text + 1]
            if first == last:
                out.append((UNKNOWN, 0.0, []))
                continue
            own, sizes = labels[first:last], letters[first:last]
            share = np.bincount(own, sizes, len(model.languages))
            best = int(share.argmax())
            changes = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [last - first]])
            begin = words.text_starts[text]
            spans = [
                (int(words.starts[first + a] - begin), int(words.ends[first + b - 1] - begin), model.languages[own[a]])
                for a, b in zip(changes[:-1], changes[1:], strict=True)
            ]
            out.append((model.languages[best], float(share[best] / share.sum()), spans))
    return out


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with the struct ``language`` (after underscores if that name is taken): lang, score (its share of letters) and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    @F.arrow_udf("struct<lang:string,score:double,spans:array<struct<start:bigint,end:bigint,lang:string>>>")
    def label(texts: pa.Array) -> pa.Array:
        rows = label_texts([t.as_py() or "" for t in texts], shared.value, penalty)
        names = ("start", "end", "lang")
        return pa.array(
            [{"lang": a, "score": b, "spans": [dict(zip(names, s, strict=True)) for s in c]} for a, b, c in rows], kind
        )

    return docs.withColumn(fresh(docs, "language"), label(F.col(text)))
