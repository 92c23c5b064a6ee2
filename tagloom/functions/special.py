"""Distribution functions that Spark and the standard library lack."""

from __future__ import annotations

import math
from functools import lru_cache


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            c = 1.0 + top / c
            d, c = 1.0 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            step = d * c
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    tail = 0.5 * beta_cdf(df / 2, 0.5, df / (df + t * t))
    return 1.0 - tail if t > 0 else tail


@lru_cache(maxsize=100_000)
def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t by bisection; infinite at 0 and 1."""
    if p in (0.0, 1.0):
        return math.copysign(math.inf, p - 0.5)
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_quantile(1.0 - p, df)
    low, high = 0.0, 2.0
    while t_cdf(high, df) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if t_cdf(mid, df) < p else (low, mid)
        if high - low <= 1e-14 * max(1.0, high):
            break
    return (low + high) / 2


def binomial_cdf(k: int, n: int, p: float) -> float:
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


@lru_cache(maxsize=64)
def required_letters(longest: int, p: float = 0.2, confidence: float = 0.95) -> tuple[int, ...]:
    """For each length i up to ``longest``: letters needed that contamination at rate p,
    one-sided at ``confidence``, doesn't explain the rest."""
    out = []
    for i in range(longest + 1):
        below = [j for j in range(i + 1) if binomial_cdf(j, i, p) < confidence]
        out.append(i - max(below, default=0))
    return tuple(out)
