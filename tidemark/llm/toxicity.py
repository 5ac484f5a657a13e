"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps homoglyphs, accents and digit substitutions to plain letters and
everything else to blanks.  Lexicon entries are whole words or word beginnings,
learned with weights from labelled texts; exception phrases, given or learned,
cancel the entry inside them.  The weights found are normalised by the text's
length and calibrated to a probability.

The lexicon is learned from a bounded sample of labelled rows:
words and word beginnings of toxic texts are counted, and those common enough
are counted in the clean texts too.  Every row is scored, over its whole text.

Defined results: a null or empty text gets the score of a text without matches;
without toxic labelled rows that is 0 for all; a null label is not learned
from; repeated rows are scored each; an empty table gives an empty result;
other columns pass through untouched.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST, LONGEST = 4, 8
# an entry occurs in this many toxic texts and this share of them, and is that much likelier there
LEAST_TEXTS, LEAST_SHARE = 3, 0.005
LEAST_LOG_ODDS = 1.5
# log odds times the root of the toxic texts that have it: chance alone rarely gets there
LEAST_SIGNAL = 6.0
SMOOTHING = 0.5
# an exception was seen in this many clean texts and in no toxic one
LEAST_EXCEPTION = 5
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "moron test")

# fixed values: look-alikes of Latin letters, digits and signs that stand for letters
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "α": "a", "β": "b",
    "γ": "y", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
    "ɑ": "a", "ɡ": "g", "ʟ": "l", "ꞓ": "c", "ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ŧ": "t",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
_SIGN_IN_WORD = re.compile(r"[@$!|](?=[^\W_])")
_JOINERS = re.compile("[­​-‏⁠﻿̀-ͯ]")


def _plain(c: str) -> str:
    """The folded form of one character, one character long; a blank if it is no letter or digit."""
    low = c.lower()
    low = low if len(low) == 1 else c
    base = unicodedata.normalize("NFKD", low)[0].lower()
    base = HOMOGLYPHS.get(base, base)
    base = DIGITS.get(base, base)
    # l, i and 1 look alike: all become i
    return "i" if base == "l" else base if base.isalnum() else " "


class _Folding(dict):
    """A translation table that folds each character when it is first met."""

    def __missing__(self, code: int) -> str:
        folded = self[code] = _plain(chr(code))
        return folded


@cache
def _table() -> _Folding:
    return _Folding()


def fold(text: str) -> str:
    """Folded text between blanks; a blank stands for every character that is no letter or digit."""
    if not text.isascii():
        text = _JOINERS.sub("", text)
    text = _SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], text)
    return f" {text.translate(_table())} "


@dataclass
class ToxicityModel:
    """Weights by entry (`` word `` or `` beginning``), exception phrases, and the calibration."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    coefficients: tuple[float, float, float] = (-20.0, 0.0, 0.0)


class Matcher:
    """One automaton for entries and exceptions; its values are weight (None for an exception) and length."""

    def __init__(self, model: ToxicityModel):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for phrase in model.exceptions:
            key = f" {' '.join(fold(phrase).split())} "
            self.automaton.add_word(key, (None, len(key)))
        for entry, weight in model.weights.items():
            if not self.automaton.exists(entry):
                self.automaton.add_word(entry, (weight, len(entry)))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, float]]:
        """Begin and weight of matched words outside exceptions; of several entries of a word the heaviest counts."""
        if not len(self.automaton):
            return []
        found: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (weight, length) in self.automaton.iter(folded):
            begin = end - length + 1
            if weight is None:
                excused.append((begin, end))
            else:
                found[begin] = max(found.get(begin, weight), weight)
        if not excused:
            return list(found.items())
        return [(at, w) for at, w in found.items() if not any(begin <= at < end for begin, end in excused)]


def features(folded: str, matcher: Matcher) -> tuple[float, float]:
    """Weight found, and weight per hundred words; both on a logarithmic scale."""
    weight = sum(w for _, w in matcher.matches(folded))
    if not weight:
        return 0.0, 0.0
    return math.log1p(weight), math.log1p(100 * weight / max(1, len(folded.split())))


def _entries(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return found


def _counted(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
    """In how many texts each entry occurs; ``wanted`` limits the entries counted."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict(
                {"entry": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                entries = _entries(fold(text.as_py()))
                counts.update(entries if shared.value is None else entries & shared.value)
                if len(counts) > 200_000:
                    yield flush()
        yield flush()

    return rows.select("text").mapInArrow(count, "entry string, n long").groupBy("entry").agg(F.sum("n").alias("n"))


def _calibrated(rows: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on the two features, with a small ridge, by Newton's method."""
    x = np.column_stack([np.ones(len(rows)), rows])
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - labels) + ridge @ beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def fit(sample: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> ToxicityModel:
    """Learn lexicon, exceptions and calibration from ``sample`` (text, label), a bounded written table.

    To the driver come entries that at least a fixed share of the toxic texts
    has, of which there are only so many per word of a text, and two features
    per sampled row.
    """
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return ToxicityModel()
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * n_toxic))
    in_toxic = {r["entry"]: r["n"] for r in _counted(sample.where("label = 1"), None).where(F.col("n") >= least).collect()}
    in_clean = {r["entry"]: r["n"] for r in _counted(sample.where("label = 0"), set(in_toxic)).collect()}
    weights: dict[str, float] = {}
    for entry in sorted(in_toxic, key=len):
        toxic, clean = in_toxic[entry], in_clean.get(entry, 0)
        odds = math.log((toxic + SMOOTHING) / (n_toxic + 1)) - math.log((clean + SMOOTHING) / (n_clean + 1))
        if odds < LEAST_LOG_ODDS or odds * math.sqrt(toxic) < LEAST_SIGNAL:
            continue
        # a longer beginning says something new only if it is likelier than the shorter one
        shorter = max((weights.get(entry[:n], 0.0) for n in range(SHORTEST + 1, len(entry))), default=0.0)
        if odds > shorter + 0.5:
            weights[entry] = odds
    model = ToxicityModel(weights, exceptions)
    model.exceptions += _learned_exceptions(sample, model)
    rows = _features_of(sample, model)
    model.coefficients = _calibrated(rows[:, :2], rows[:, 2])
    return model


def _learned_exceptions(sample: DataFrame, model: ToxicityModel) -> tuple[str, ...]:
    """Pairs of neighbouring words around a whole-word entry that only clean texts have."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            found: list[tuple[str, int]] = []
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                folded, own = fold(text.as_py()), set()
                for begin, _ in matcher.matches(folded):
                    word = folded[begin + 1 : folded.index(" ", begin + 1)]
                    before = folded[max(0, begin - 40) : begin].split()[-1:]
                    after = folded[begin + 1 + len(word) : begin + 41 + len(word)].split()[:1]
                    own.update(f"{b} {word}" for b in before)
                    own.update(f"{word} {a}" for a in after)
                found += [(phrase, label.as_py()) for phrase in own]
            yield pa.RecordBatch.from_pydict(
                {"phrase": pa.array([p for p, _ in found], pa.string()), "label": pa.array([x for _, x in found], pa.int32())}
            )

    counted = sample.select("text", "label").mapInArrow(pairs, "phrase string, label int").groupBy("phrase").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("n")
    )
    return tuple(sorted(r["phrase"] for r in counted.where((F.col("toxic") == 0) & (F.col("n") >= LEAST_EXCEPTION)).collect()))


def _features_of(sample: DataFrame, model: ToxicityModel) -> np.ndarray:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            rows = [features(fold(text.as_py()), matcher) for text in batch.column(0)]
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([r[0] for r in rows], pa.float64()), "b": pa.array([r[1] for r in rows], pa.float64()), "label": batch.column(1)}
            )

    table = sample.select("text", "label").mapInArrow(measure, "a double, b double, label int").orderBy("a", "b", "label").toArrow()
    return np.column_stack([table[c].to_numpy() for c in ("a", "b", "label")])


_matchers: dict[int, tuple[object, Matcher]] = {}


def _matcher(key: int, model: ToxicityModel) -> Matcher:
    """One matcher per worker and model."""
    if key not in _matchers or _matchers[key][0] is not model:
        _matchers.clear()
        _matchers[key] = (model, Matcher(model))
    return _matchers[key][1]


def scored(text: Column, model: ToxicityModel, spark) -> Column:
    """The calibrated toxicity of a text column, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        own = shared.value
        matcher = _matcher(id(own), own)
        bias, by_weight, by_rate = own.coefficients
        out = []
        for text in texts:
            weight, rate = features(fold(text.as_py() or ""), matcher)
            out.append(1 / (1 + math.exp(-min(30.0, max(-30.0, bias + by_weight * weight + by_rate * rate)))))
        return pa.array(out, pa.float64())

    return score(text)
