"""Scalar distribution functions for test statistics (pure Python).

They run on one already aggregated row (the statistic and its degrees of
freedom), never per data row. Student t uses the regularised incomplete beta
function by its continued fraction (Lentz's method); the normal uses the
standard library.
"""

from __future__ import annotations

import math
from statistics import NormalDist

_N01 = NormalDist()


def _betacf(a: float, b: float, x: float, iters: int = 300, eps: float = 1e-15) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return float("nan")
    x = df / (df + t * t)
    tail = 0.5 * betainc(df / 2.0, 0.5, x)
    return 1.0 - tail if t > 0 else tail


def t_pvalue(t: float, df: float, alternative: str = "two-sided") -> float:
    if t is None or df is None:
        return float("nan")
    if alternative == "less":
        return t_cdf(t, df)
    if alternative == "greater":
        return 1.0 - t_cdf(t, df)
    return min(1.0, 2.0 * (1.0 - t_cdf(abs(t), df)))


def normal_cdf(z: float) -> float:
    return _N01.cdf(z)


def normal_ppf(p: float) -> float:
    return _N01.inv_cdf(p)


def z_for_level(level: float) -> float:
    """Two-sided critical value for a confidence level (0.95 -> 1.959963...)."""
    return normal_ppf(0.5 + level / 2.0)
