"""Two-sided p-value of the two-sample Kolmogorov-Smirnov statistic.

Exact for samples of at most 10,000; the exact law counts lattice paths
(Hodges 1958).  Beyond that, the statistic is compared with the one-sample law
at n1*n2/(n1+n2), by the Kolmogorov series with Vrbik's (2018) finite-sample
argument.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_LIMIT = 10_000
METHODS = ("auto", "exact", "asymptotic")


def _exact_equal(n: int, h: int) -> float:
    """P(D >= h/n) for two samples of n, by the reflection series on log binomials."""
    centre = math.lgamma(n + 1)
    total = 0.0
    for k in range(n // h, 0, -1):
        shift = k * h
        ratio = 2 * centre - math.lgamma(n - shift + 1) - math.lgamma(n + shift + 1)
        total = math.exp(ratio) * (1 if k % 2 else -1) + total
    return 2.0 * total


def _exact_unequal(n1: int, n2: int, h: int, g: int) -> float:
    """P(D >= h/lcm) by the path recursion, one anti-diagonal of the (i, j) grid at a time.

    ``v(i, j)`` is the share of monotone paths to (i, j) that leave the band
    |i*n2 - j*n1| < h*g on the way: 1 outside it, inside it the mean of its two
    predecessors, weighted by j and i.  Carrying the small share itself, not
    its complement, keeps p-values far below the rounding of 1, and only the
    band's part of a diagonal is kept.
    """
    reach, both = h * g, n1 + n2
    previous, low = np.zeros(1), 0
    for total in range(1, both + 1):
        first = max(0, total - n2, (total * n1 - reach) // both + 1)
        last = min(n1, total, -((-total * n1 - reach) // both) - 1)
        if last < first:
            return 1.0
        i = np.arange(first, last + 1)
        padded = np.ones(last - first + 2)
        # index k of ``padded`` holds v for i = first - 1 + k on the previous diagonal, 1 where that is outside
        begin, end = max(low, first - 1), min(low + len(previous), last + 1)
        if end > begin:
            padded[begin - first + 1 : end - first + 1] = previous[begin - low : end - low]
        previous, low = ((total - i) * padded[1:] + i * padded[:-1]) / total, first
    return float(previous[0])


def _limiting(d: float, n1: int, n2: int) -> float:
    n = max(1, round(n1 * n2 / (n1 + n2)))
    z = math.sqrt(n) * d
    x = z + 1.0 / (6.0 * math.sqrt(n)) + (z - 1.0) / (4.0 * n)
    if x < 0.2:
        return 1.0
    terms = ((-1) ** (k - 1) * math.exp(-2.0 * (k * x) ** 2) for k in range(1, 101))
    return 2.0 * math.fsum(terms)


def law_used(n1: int, n2: int, method: str = "auto") -> str:
    """``exact`` or ``asymptotic``; ``auto`` is exact for samples of at most ``EXACT_LIMIT``."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method != "auto":
        return method
    return "exact" if max(n1, n2) <= EXACT_LIMIT else "asymptotic"


def two_sample_p_value(d: float, n1: int, n2: int, method: str = "auto") -> float:
    """P(D >= d) under equal distributions; NaN when any argument is missing."""
    if any(v is None or v != v for v in (d, n1, n2)) or n1 < 1 or n2 < 1:
        return float("nan")
    n1, n2 = int(n1), int(n2)
    if law_used(n1, n2, method) == "asymptotic":
        p = _limiting(d, n1, n2)
    else:
        g = math.gcd(n1, n2)
        h = round(d * (n1 // g * n2))
        if h == 0:
            return 1.0
        p = _exact_equal(n1, h) if n1 == n2 else _exact_unequal(n1, n2, h, g)
    return min(1.0, max(0.0, p))


def ks_p_value(d: Column, n1: Column, n2: Column, method: str = "auto") -> Column:
    """Arrow form of ``two_sample_p_value``; called on one row per feature or window."""

    @F.pandas_udf(T.DoubleType())
    def p_value(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return pd.Series([two_sample_p_value(*row, method) for row in zip(d, n1, n2)], dtype="float64")

    return p_value(d, n1, n2)


def ks_law(n1: Column, n2: Column, method: str = "auto") -> Column:
    """``law_used`` of two columns of sample sizes."""
    if method != "auto":
        return F.lit(law_used(1, 1, method))
    return F.when(F.greatest(n1, n2) <= EXACT_LIMIT, "exact").otherwise("asymptotic")
