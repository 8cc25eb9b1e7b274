"""Tests and tails of the statistics that reports use: Python kernels with Arrow functions over them."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def log_binomial(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def fisher(a: int, b: int, c: int, d: int) -> float:
    """Two-sided Fisher exact test of a 2 x 2 table: the sum of all tables no likelier than this one."""
    row, col, total = a + b, a + c, a + b + c + d
    if total == 0:
        return 1.0
    chance = lambda x: math.exp(log_binomial(row, x) + log_binomial(total - row, col - x) - log_binomial(total, col))
    here = chance(a)
    return min(1.0, sum(p for x in range(max(0, col - (total - row)), min(row, col) + 1) if (p := chance(x)) <= here * (1 + 1e-7)))


def binomial_two_sided(n: int, k: int, p: float = 0.5) -> float:
    """Twice the smaller tail, one at most."""
    if n == 0:
        return 1.0
    term = lambda i: math.exp(log_binomial(n, i) + i * math.log(p) + (n - i) * math.log1p(-p))
    low, high = sum(map(term, range(0, k + 1))), sum(map(term, range(k, n + 1)))
    return min(1.0, 2 * min(low, high))


def hardy_weinberg(het: int, hom_ref: int, hom_alt: int) -> float:
    """Exact test of Hardy-Weinberg proportions: the sum of heterozygote counts no likelier than this one."""
    n = het + hom_ref + hom_alt
    if n == 0:
        return 1.0
    rare = 2 * min(hom_ref, hom_alt) + het
    log_chance = lambda h: h * math.log(2) - sum(math.lgamma(x + 1) for x in ((rare - h) // 2, h, n - (rare - h) // 2 - h))
    counts = range(rare % 2, rare + 1, 2)
    logs = {h: log_chance(h) for h in counts if n - (rare - h) // 2 - h >= 0}
    top = max(logs.values())
    total = sum(math.exp(v - top) for v in logs.values())
    return min(1.0, sum(math.exp(v - top) for v in logs.values() if v <= logs[het] + 1e-9) / total)


@F.pandas_udf(T.DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return pd.Series([None if any(pd.isna(x) for x in v) else fisher(*map(int, v)) for v in zip(a, b, c, d)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def binomial_test(n: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) or pd.isna(y) else binomial_two_sided(int(x), int(y)) for x, y in zip(n, k)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def hwe_test(het: pd.Series, ref: pd.Series, alt: pd.Series) -> pd.Series:
    return pd.Series([hardy_weinberg(int(a), int(b), int(c)) for a, b, c in zip(het, ref, alt)], dtype="float64")


def phred(p: Column) -> Column:
    return -10 * F.log10(p)


def quality_text(qualities: str = "qualities", offset: int = 33) -> Column:
    """An array of qualities as text."""
    return F.expr(f"array_join(transform({qualities}, q -> char(q + {offset})), '')")
