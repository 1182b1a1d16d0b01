"""Indel similarity: as Catalyst expressions, and as bit-parallel Arrow functions for long texts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by dynamic programming over arrays of characters."""
    other = F.split(b, "")
    first = F.array_repeat(F.lit(0), F.length(b) + 1)

    def row(previous: Column, ch: Column) -> Column:
        cells = F.sequence(F.lit(1), F.length(b))
        return F.aggregate(
            cells,
            F.array(F.lit(0)),
            lambda now, j: F.array_append(now, F.when(F.get(other, j - 1) == ch, F.get(previous, j - 1) + 1).otherwise(F.greatest(F.get(previous, j), F.element_at(now, -1)))),
        )

    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.element_at(F.aggregate(F.split(a, ""), first, row), -1))


def ratio(a: Column, b: Column) -> Column:
    """200 LCS / (|a| + |b|); 100 for two empty texts."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs(a, b) / total)


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel: one big-integer step for each character of ``b``."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = full
    for ch in b:
        hit = rows & masks.get(ch, 0)
        rows = (rows + hit | rows - hit) & full
    return len(a) - rows.bit_count()


def ratio_of(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def token_set_ratio_of(a: str, b: str) -> float:
    """Best ratio among the sorted common tokens and these with the tokens of either side."""
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    common, l_text, r_text = " ".join(both), " ".join(left), " ".join(right)
    gap = 1 if both else 0
    l_size, r_size = len(common) + gap + len(l_text), len(common) + gap + len(r_text)
    # the common part and its space match; what remains is compared
    best = 200.0 * (len(common) + gap + lcs_length(l_text, r_text)) / (l_size + r_size) if l_size + r_size else 100.0
    if both:
        best = max(best, *(200.0 * len(common) / (len(common) + n) for n in (l_size, r_size)))
    return best


def token_set_ratio(a: Column, b: Column) -> Column:
    """The same as an expression."""
    x, y = (F.array_distinct(F.filter(F.split(c, r"\s+"), lambda t: t != "")) for c in (a, b))
    both = F.array_sort(F.array_intersect(x, y))
    left, right = F.array_sort(F.array_except(x, y)), F.array_sort(F.array_except(y, x))
    common = F.array_join(both, " ")
    l_text, r_text = (F.array_join(F.concat(both, s), " ") for s in (left, right))
    of_lengths = lambda t: 200.0 * F.length(common) / (F.length(common) + F.length(t))
    best = ratio(l_text, r_text)
    return (
        F.when((F.length(a) == 0) | (F.length(b) == 0), 0.0)
        .when((F.size(both) > 0) & ((F.size(left) == 0) | (F.size(right) == 0)), 100.0)
        .when(F.size(both) == 0, best)
        .otherwise(F.greatest(best, of_lengths(l_text), of_lengths(r_text)))
    )


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """``ratio`` for texts too long for the expression. Null if either is null."""
    return pd.Series([None if x is None or y is None else ratio_of(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(T.DoubleType())
def token_set_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set_ratio_of(x, y) for x, y in zip(a, b, strict=True)], dtype=float)
