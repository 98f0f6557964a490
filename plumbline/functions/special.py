"""Tail probabilities, applied to aggregated rows only.

The Kolmogorov series is plain column math. The normal and Student-t tails are
small Arrow UDFs over the handful of rows an aggregate leaves.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float | None, df: float | None) -> float | None:
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return None
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def normal_two_sided(z: float | None) -> float | None:
    if z is None or math.isnan(z):
        return None
    return math.erfc(abs(z) / math.sqrt(2.0))


def kolmogorov_tail(lam: float) -> float:
    if lam <= 0:
        return 1.0
    if lam < 1.18:
        s = sum(math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * lam * lam)) for k in range(1, 21))
        return 1.0 - math.sqrt(2 * math.pi) / lam * s
    return 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 21))


def wilcoxon_exact(w: float, n: int) -> float:
    """Exact two-sided signed-rank p for ``n`` untied differences (n <= 50)."""
    counts = [1] + [0] * (n * (n + 1) // 2)
    for r in range(1, n + 1):
        for s in range(len(counts) - 1, r - 1, -1):
            counts[s] += counts[s - r]
    low = int(min(w, n * (n + 1) / 2 - w))
    return min(1.0, 2.0 * sum(counts[: low + 1]) / 2.0**n)


def ks_exact(d: float, n: int, m: int) -> float:
    """Exact P(D >= d) of two untied samples: the share of lattice paths from (0, 0) to (n, m) that
    leave the band |i/n - j/m| < d. Rows are rescaled, so counts of any size fit; n * m steps."""
    if n < 1 or m < 1:
        return math.nan
    j = np.arange(m + 1)
    inside = lambda i: np.abs(i * m - j * n) < d * n * m * (1 - 1e-12)
    row, log = np.where(np.cumprod(inside(0)), 1.0, 0.0), 0.0
    for i in range(1, n + 1):
        at = np.flatnonzero(inside(i))
        fresh = np.zeros(m + 1)
        if len(at):
            fresh[at] = np.cumsum(row[at])
        top = fresh.max()
        if top == 0:
            return 1.0
        row, log = fresh / top, log + math.log(top)
    if row[m] == 0:
        return 1.0
    paths = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(row[m]) + log - paths)))


def mann_whitney_exact(u: float, n: int, m: int) -> float:
    """Exact two-sided p of U for untied samples, from the number of arrangements with each U."""
    if n < 1 or m < 1:
        return math.nan
    ways = [1] + [0] * (n * m)
    for k in range(1, n + 1):  # times (1 - q^(m + k)) / (1 - q^k)
        for s in range(n * m, m + k - 1, -1):
            ways[s] -= ways[s - m - k]
        for s in range(k, n * m + 1):
            ways[s] += ways[s - k]
    low = int(min(u, n * m - u))
    return min(1.0, 2.0 * sum(ways[: low + 1]) / math.comb(n + m, n))


@F.pandas_udf(DoubleType())
def ks_exact_pvalue(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_exact(a, int(b), int(c)) for a, b, c in zip(d, n, m)], dtype="float64")


@F.pandas_udf(DoubleType())
def mann_whitney_exact_pvalue(u: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([mann_whitney_exact(a, int(b), int(c)) for a, b, c in zip(u, n, m)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(v) for v in z], dtype="float64")


@F.pandas_udf(DoubleType())
def wilcoxon_pvalue(w: pd.Series, n: pd.Series, z: pd.Series, exact: pd.Series) -> pd.Series:
    return pd.Series(
        [
            wilcoxon_exact(a, int(b)) if e and b > 0 else normal_two_sided(c)
            for a, b, c, e in zip(w, n, z, exact)
        ],
        dtype="float64",
    )


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sided p of a two-sample KS statistic, as column math."""
    lam = F.sqrt(n.cast("double") * m / (n + m)) * d
    ks = F.sequence(F.lit(1), F.lit(20))
    small = F.lit(1.0) - F.sqrt(F.lit(2 * math.pi)) / F.nullif(lam, F.lit(0.0)) * F.aggregate(
        ks,
        F.lit(0.0),
        lambda acc, k: acc
        + F.exp(-(2 * k - 1) * (2 * k - 1) * F.lit(math.pi**2) / (8 * lam * lam)),
    )
    large = F.lit(2.0) * F.aggregate(
        ks,
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    return (
        F.when(lam <= 1e-9, F.lit(1.0))
        .when(lam < 1.18, small)
        .otherwise(F.greatest(large, F.lit(0.0)))
    )


# Coefficients of the rational approximation of the normal quantile
# (Acklam's published algorithm, relative error below 1.2e-9).
_QA = [-39.69683028665376, 220.9460984245205, -275.9285104469687,
       138.3577518672690, -30.66479806614716, 2.506628277459239]
_QB = [-54.47609879822406, 161.5858368580409, -155.6989798598866,
       66.80131188771972, -13.28068155288572]
_QC = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838,
       -2.549732539343734, 4.374664141464968, 2.938163982698783]
_QD = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416]
_Q_TAIL = 0.02425


def _horner(coefs: list[float], x: Column) -> Column:
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse normal CDF as column math, so it stays on the JVM for row-sized data."""
    def tail(u: Column) -> Column:
        r = F.sqrt(-2.0 * F.log(u))
        return _horner(_QC, r) / _horner([*_QD, 1.0], r)

    q = p - 0.5
    r = q * q
    middle = _horner(_QA, r) * q / _horner([*_QB, 1.0], r)
    return (
        F.when(p < _Q_TAIL, tail(p)).when(p > 1 - _Q_TAIL, -tail(1 - p)).otherwise(middle)
    )


def shapiro_francia_z(w: Column, n: Column) -> Column:
    """Normal score of a Shapiro-Francia W' (Royston 1993, n from 5)."""
    u = F.log(n.cast("double"))
    v = F.log(u)
    mu = F.lit(-1.2725) + F.lit(1.0521) * (v - u)
    sigma = F.lit(1.0308) - F.lit(0.26758) * (v + 2.0 / u)
    return (F.log(1 - w) - mu) / sigma
