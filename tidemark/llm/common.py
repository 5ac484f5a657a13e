"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

# white space between words: blank, tab, line feed, vertical tab, form feed, carriage return
SPACE_CLASS = r"[\x20\x09-\x0D]"
NOT_SPACE_CLASS = r"[^\x20\x09-\x0D]"


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def id_share(column: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % folds


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` at most, chosen by a hash of ``key``, whatever the size of ``df``.

    A count and a comparison of hashes; rows are not sorted or moved.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * rows / total))


def slices(texts: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """``texts`` without nulls in consecutive parts of about ``most_bytes``; a longer text is a part alone."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + most_bytes, "right")))
        yield texts[begin:end]
        begin = end


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins, with the end as last entry."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = int(ends[0]), int(ends[-1])
    body = np.frombuffer(data, np.uint8)[first:last] if last > first else np.zeros(0, np.uint8)
    return body, ends - first


def word_bounds(is_space: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in concatenated texts, and each text's first word, with the count as last entry."""
    inside = ~is_space
    first = inside.copy()
    first[1:] &= is_space[:-1]
    final = inside.copy()
    final[:-1] &= is_space[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(is_space))]
    first[edges] = inside[edges]
    final[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(final) + 1, np.searchsorted(starts, offsets)


_BASE, _UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n + 1:
        tables = []
        for base in (_BASE, _UNBASE):
            table = np.full(max(n + 1, 1 << 20), base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[:] = tables
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span of ``codes``, from one running sum."""
    powers, inverses = _power_tables(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(0x1F3)) * powers[: len(codes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


FIT_ROWS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """A written table (text, label) of about ``fit_rows`` labelled documents at most.

    The labels are sampled first, by a hash of their ids, so that what is
    broadcast to the documents is bounded by ``fit_rows``; documents are not
    shuffled.  Of several labels of one id the largest counts.
    """
    given = labels.where(learn_from & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = bounded_sample(given, F.col("doc_id"), fit_rows).withColumnRenamed("doc_id", "_labelled")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))
    return materialise(joined.select("text", "label"), "labelled-sample")
