"""Vectorised distribution tails for small, already aggregated tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in x])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz iteration)."""
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    total = d.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / guard(1.0 + term * d)
            c = guard(1.0 + term / c)
            total *= d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return total


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) for Student's t; 1 where the inputs are undefined."""
    out = np.ones(len(t))
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0) & (t != 0)
    t, df = t[ok], df[ok]
    x = df / (df + t * t)
    a, b = df / 2.0, np.full(len(df), 0.5)
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(x) + b * np.log1p(-x))
    direct = x < (a + 1.0) / (a + b + 2.0)
    p = np.where(
        direct,
        front * _beta_fraction(a, b, x) / a,
        1.0 - front * _beta_fraction(b, a, 1.0 - x) / b,
    )
    out[ok] = np.clip(p, 0.0, 1.0)
    return out


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(student_two_sided(t.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(T.DoubleType())
def log_hypergeom_tail(total: pd.Series, marked: pd.Series, drawn: pd.Series, hits: pd.Series) -> pd.Series:
    """ln P(X >= hits) when ``drawn`` of ``total`` are taken and ``marked`` of them count.

    Kept as a logarithm, as the probability itself can be too small for a double.
    """

    def ln_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    def tail(n: int, m: int, d: int, h: int) -> float:
        low, high = max(h, d + m - n, 0), min(m, d)
        whole = ln_choose(n, d)
        terms = [ln_choose(m, i) + ln_choose(n - m, d - i) - whole for i in range(low, high + 1)]
        if not terms:
            return -math.inf
        top = max(terms)
        return min(top + math.log(math.fsum(math.exp(t - top) for t in terms)), 0.0)

    rows = zip(total, marked, drawn, hits)
    return pd.Series([tail(int(n), int(m), int(d), int(h)) for n, m, d, h in rows], dtype=float)
