"""Tail probabilities for rows that are one per feature."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by Lentz's continued fraction."""
    if not (x == x and a > 0 and b > 0):
        return math.nan
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1 + term * d
            c = 1 + term / c
            d = 1 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            out *= step
        if abs(step - 1) < 1e-15:
            break
    return front * out


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t)) if t == t and df == df else math.nan


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f == f else math.nan


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2)) if z == z else math.nan


def _per_row(fn, *cols: Column | str) -> Column:
    @F.pandas_udf("double")
    def apply(*s: pd.Series) -> pd.Series:
        arrays = [x.to_numpy(np.float64) for x in s]
        return pd.Series([fn(*v) for v in zip(*arrays)], dtype="float64")

    return apply(*[F.col(c) if isinstance(c, str) else c for c in cols])


def t_pvalue(t, df) -> Column:
    return _per_row(t_two_sided, t, df)


def f_pvalue(f, d1, d2) -> Column:
    return _per_row(f_upper, f, d1, d2)


def normal_pvalue(z) -> Column:
    return _per_row(normal_two_sided, z)


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sample p: 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2), k = 1..100.

    Below lambda = 0.2 the limit distribution equals 1 to 9 places and the
    series no longer converges within its terms.
    """
    n1, n2 = n1.cast("double"), n2.cast("double")
    lam2 = d * d * (n1 * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda s, k: s + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * k * k * lam2))
    return F.when(lam2 < 0.04, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
