"""Chronological splits, exact seeded holdouts and exact seeded samples.

A split is a comparison with a boundary row, so the wide rows are never
shuffled: only the order keys (or key hashes) are examined to find the
boundary.  Where equal keys straddle a boundary the rows are placed by
position instead, so sizes are exact in every case.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import SMALL, boundary_rows, key_struct, row_position

_HASH = "_hash"
_DIGITS_PER_ROUND = 3  # 16**3 counters per pass
_HASH_LENGTH = 32


def sort_by_time(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Ascending sort by the time key and its tie-breakers."""
    return df.orderBy(*order)


def split_sizes(rows: int, fractions: Sequence[float]) -> list[int]:
    """Sizes of consecutive parts: each is truncated, the last takes the rest."""
    sizes = [int(rows * f) for f in fractions]
    return [*sizes, rows - sum(sizes)]


def _split_conditions(
    df: DataFrame, order: Sequence[str], sizes: Sequence[int]
) -> list[Column] | None:
    """For each part but the last, "belongs to this or an earlier part"; None when equal keys straddle a cut."""
    total = sum(sizes)
    cuts = [sum(sizes[: i + 1]) for i in range(len(sizes) - 1)]
    found = boundary_rows(df, order, sorted({c for c in cuts if 0 < c < total}), total)
    here = F.struct(*[F.col(k) for k in order])
    conditions = []
    for cut in cuts:
        if cut not in found:
            conditions.append(F.lit(cut > 0))
            continue
        last, following = found[cut]
        if last == following:
            return None
        conditions.append(here <= key_struct(df, order, last))
    return conditions


def _label_parts(conditions: Sequence[Column], names: Sequence[str]) -> Column:
    label = F.lit(names[-1])
    for condition, name in reversed(list(zip(conditions, names))):
        label = F.when(condition, name).otherwise(label)
    return label


def chronological_split(
    df: DataFrame,
    order: Sequence[str],
    fractions: Sequence[float] = (0.70, 0.15),
    names: Sequence[str] = ("train", "validation", "test"),
    column: str = "split",
) -> DataFrame:
    """Label contiguous parts of ``df`` in ``order``; part sizes follow ``split_sizes``."""
    if len(names) != len(fractions) + 1:
        raise ValueError("give one name more than fractions")
    sizes = split_sizes(df.count(), fractions)
    conditions = _split_conditions(df, order, sizes)
    if conditions is None:
        placed = row_position(df, order, name="_position")
        cuts = [F.col("_position") <= sum(sizes[: i + 1]) for i in range(len(fractions))]
        return placed.withColumn(column, _label_parts(cuts, names)).drop("_position")
    return df.withColumn(column, _label_parts(conditions, names))


def part_sizes(df: DataFrame, column: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def seeded_hash(seed: int, keys: Sequence[str]) -> Column:
    """Uniform text hash of a row key; the same on every engine and partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _hash_boundary(
    hashed: DataFrame, rank_for: Sequence[float] | int, ties: Sequence[str]
) -> tuple[int, list[str] | None]:
    """Row at a rank of the (hash, ties) order, found by counting hash prefixes.

    ``rank_for`` is the rank, or a one-element fraction of the row count (rounded up).
    Each pass returns 4,096 counters to the driver and shuffles nothing else.
    """
    prefix, rank, order = "", None, [_HASH, *ties]
    while True:
        inside = hashed.filter(F.col(_HASH).startswith(prefix)) if prefix else hashed
        width = len(prefix) + _DIGITS_PER_ROUND
        counts = sorted(
            (row["p"], row["n"])
            for row in inside.groupBy(F.substring(_HASH, 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        if rank is None:
            total = sum(n for _, n in counts)
            rank = rank_for if isinstance(rank_for, int) else math.ceil(total * rank_for[0])
            if rank <= 0 or rank >= total:
                return rank - total, None
        for candidate, rows in counts:
            if rank <= rows:
                prefix = candidate
                break
            rank -= rows
        if rows <= SMALL or len(prefix) >= _HASH_LENGTH:
            break
    if rows > SMALL:
        raise _CrowdedHash
    tail = hashed.filter(F.col(_HASH).startswith(prefix)).select(
        *[F.col(c).cast("string").alias(f"_s_{c}") for c in order], *order
    )
    ordered = tail.orderBy(*order).limit(rank + 1).collect()
    keys = [[row[f"_s_{c}"] for c in order] for row in ordered]
    if len(keys) > rank and keys[rank] == keys[rank - 1]:
        raise _CrowdedHash
    return 0, keys[rank - 1]


class _CrowdedHash(Exception):
    """Equal keys straddle the boundary; the caller places rows by position."""


def _first_by_hash(
    df: DataFrame, rank_for, keys: Sequence[str], seed: int, ties: Sequence[str], column: str
) -> DataFrame:
    """Flag the first rows in seeded hash order."""
    hashed = df.withColumn(_HASH, seeded_hash(seed, keys))
    order = [_HASH, *ties]
    try:
        beyond, boundary = _hash_boundary(hashed.select(*order), rank_for, ties)
    except _CrowdedHash:
        rank = rank_for if isinstance(rank_for, int) else math.ceil(df.count() * rank_for[0])
        placed = row_position(hashed, order, name="_position")
        return placed.withColumn(column, F.col("_position") <= rank).drop("_position", _HASH)
    if boundary is None:
        return df.withColumn(column, F.lit(beyond >= 0))
    types = {f.name: f.dataType for f in hashed.schema.fields}
    limit = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, boundary)])
    flag = F.struct(*[F.col(c) for c in order]) <= limit
    return hashed.withColumn(column, flag).drop(_HASH)


def random_holdout(
    df: DataFrame,
    keys: Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    ties: Sequence[str] = (),
    column: str = "split",
) -> DataFrame:
    """Label exactly ``ceil(test_fraction * n)`` rows test and the rest train."""
    flagged = _first_by_hash(df, (test_fraction,), keys, seed, ties, "_test")
    return flagged.withColumn(column, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def sample_exact(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 42, ties: Sequence[str] = ()
) -> DataFrame:
    """Exactly ``n`` rows without replacement; an error when there are fewer."""
    available = df.select(*keys).limit(n).count()
    if available < n:
        raise ValueError(f"cannot take {n} rows from {available}")
    if n > SMALL:
        return _first_by_hash(df, n, keys, seed, ties, "_taken").filter("_taken").drop("_taken")
    hashed = df.withColumn(_HASH, seeded_hash(seed, keys))
    # rows equal in hash and ties are taken by a hash of all they hold, as their positions are
    return hashed.orderBy(_HASH, *ties, F.xxhash64(*df.columns)).limit(n).drop(_HASH)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    """One row holding the row count."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
