"""Similarity of names: a Jaro-Winkler measure with its own prefix and window rules, over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType


@lru_cache(maxsize=200_000)
def jaro_winkler(a: str, b: str, upper: bool = True) -> float:
    """Similarity of two names from 0 to 1.

    Equal names give 1, an empty one 0. The prefix bonus counts equal letters at the start, at most four, and one less
    than the length for a whole name of less than five letters that begins the other. Letters match within a window of
    half the longer length less one whose upper bound is excluded.
    """
    if upper:
        a, b = a.upper(), b.upper()
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    head = min(5, len(short))
    prefix = next((i for i in range(head) if short[i] != long[i]), head - 1)
    reach = max(len(long) // 2 - 1, 0)
    free = [True] * len(short)
    pairs = []
    for i, letter in enumerate(long):
        lo, hi = max(0, i - reach), min(len(short), i + reach)
        for j in range(lo, hi if hi > lo else min(lo + 1, len(short))):
            if free[j] and short[j] == letter:
                free[j] = False
                pairs.append(j)
                break
    m = len(pairs)
    if not m:
        return 0.0
    swapped = sum(short[j] != short[k] for j, k in zip(pairs, sorted(pairs), strict=True)) / 2
    base = (m / len(short) + m / len(long) + (m - swapped) / m) / 3
    return base + 0.1 * prefix * (1 - base)


def person_similarity(a: str, b: str) -> float:
    """For `last, first` names: 0 unless one first part contains the other, then similarities of the parts weighted by length."""
    x, y = re.split(" ?[.,] ?", a), re.split(" ?[.,] ?", b)
    if len(x) == len(y) == 2:
        if x[1] not in y[1] and y[1] not in x[1]:
            return 0.0
        n = [max(len(p), len(q)) for p, q in zip(x, y, strict=True)]
        return sum(k * jaro_winkler(p, q) for k, p, q in zip(n, x, y, strict=True)) / sum(n) if sum(n) else 0.0
    return jaro_winkler(a, b)


def _pairwise(f):
    @F.pandas_udf(DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def name_similarity(a: Column, b: Column) -> Column:
    """jaro_winkler of two columns; null if either is null."""
    return _pairwise(jaro_winkler)(a, b)


def inventor_similarity(a: Column, b: Column) -> Column:
    """person_similarity of two columns; null if either is null."""
    return _pairwise(person_similarity)(a, b)


@F.pandas_udf(BooleanType())
def any_unlike(s: pd.Series) -> pd.Series:
    """Whether two names of a list between bars have no similarity at all."""

    def one(x: str | None) -> bool | None:
        names = (x or "").split("|")
        return None if x is None else any(person_similarity(p, q) == 0 for i, p in enumerate(names) for q in names[i + 1 :])

    return s.map(one)
