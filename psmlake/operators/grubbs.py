"""Critical values of Grubbs' two-sided outlier test, computed once for each group size."""

from __future__ import annotations

import math
from functools import lru_cache


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return h


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_quantile(p: float, df: int) -> float:
    """Student's t with upper tail 1 - p, p above one half, by bisection."""
    upper = lambda t: 0.5 * beta_share(df / 2, 0.5, df / (df + t * t))
    low, high = 0.0, 1.0
    while upper(high) > 1 - p:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if upper(middle) > 1 - p else (low, middle)
    return (low + high) / 2


@lru_cache(maxsize=None)
def critical(n: int, alpha: float) -> float:
    """G above which the most distant of n values is an outlier; infinite for fewer than three."""
    if n < 3:
        return math.inf
    t = t_quantile(1 - alpha / (2 * n), n - 2)
    return (n - 1) / math.sqrt(n) * math.sqrt(t * t / (n - 2 + t * t))
