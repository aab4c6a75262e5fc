"""Scalar statistics used on the driver.

Nothing here touches data-sized input: quantiles are computed once per
design on the driver.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(48)

# From this many degrees of freedom the expansion of the t quantile around the
# normal one differs from the integral below by less than 1e-12.
EXPAND_DF = 1000


def t_central(t: float, df: float) -> float:
    """P(0 < T < t) of Student's t: with tan(phi) = T / sqrt(df) the density
    becomes cos(phi) ** (df - 1), a smooth integrand for Gauss quadrature."""
    theta = math.atan(t / math.sqrt(df))
    edges = np.linspace(0.0, theta, 17)
    mid, half = (edges[1:] + edges[:-1]) / 2, (edges[1:] - edges[:-1]) / 2
    phi = mid[:, None] + half[:, None] * _NODES
    area = float((half[:, None] * _WEIGHTS * np.cos(phi) ** (df - 1.0)).sum())
    return area * _gamma_ratio(df / 2) / math.sqrt(math.pi)


def _gamma_ratio(x: float) -> float:
    """Gamma(x + 1/2) / Gamma(x); by its asymptotic series where the difference
    of two large logarithms would lose digits."""
    if x < 50:
        return math.gamma(x + 0.5) / math.gamma(x)
    return math.sqrt(x) * math.exp(-1 / (8 * x) + 1 / (192 * x**3) - 1 / (640 * x**5) + 17 / (14336 * x**7))


def _expanded(p: float, df: float) -> float:
    z = normal_quantile(p)
    terms = ((z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
             (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160)
    return z + sum(c / df ** (k + 1) for k, c in enumerate(terms))


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t at any degrees of freedom."""
    if df is None or df <= 0:
        return float("nan")
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    if math.isinf(df):
        return normal_quantile(p)
    if df >= EXPAND_DF:
        return _expanded(p, df)
    low, high = 0.0, 1.0
    while t_central(high, df) < p - 0.5:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if t_central(mid, df) < p - 0.5 else (low, mid)
    return (low + high) / 2


def two_sided_crit(level: float, df: float) -> float:
    """t critical value for a two-sided interval at ``level``."""
    return t_quantile((1.0 + level) / 2.0, df)
