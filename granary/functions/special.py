"""Tail probabilities of the chi-square, F, t and normal distributions, in plain Python for single statistics."""

from __future__ import annotations

import math


def _continued(term: object, steps: int = 400) -> float:
    """Lentz's method for b0 + a1 / (b1 + a2 / (b2 + ...)); term(k) gives (a, b)."""
    tiny = 1e-300
    f = term(0)[1] or tiny
    c, d = f, 0.0
    for k in range(1, steps):
        a, b = term(k)
        d = 1 / ((b + a * d) or tiny)
        c = (b + a / c) or tiny
        f *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return f


def upper_gamma(a: float, x: float) -> float:
    """Regularized upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for k in range(1, 1000):
            term *= x / (a + k)
            total += term
            if term < total * 1e-16:
                break
        return 1 - scale * total
    return scale / _continued(lambda k: (-k * (k - a), x + 1 - a + 2 * k))


def beta(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta(b, a, 1 - x)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a

    def term(k: int) -> tuple[float, float]:
        if k == 0:
            return 0.0, 1.0
        m = k // 2
        if k % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return scale / _continued(term)


def chi_square_tail(x: float, freedom: float) -> float:
    return upper_gamma(freedom / 2, x / 2)


def f_tail(x: float, between: float, within: float) -> float:
    return beta(within / 2, between / 2, within / (within + between * x)) if x > 0 else 1.0


def t_two_sided(t: float, freedom: float) -> float:
    return beta(freedom / 2, 0.5, freedom / (freedom + t * t))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def rank_sum_tail(u: int, a: int, b: int) -> float:
    """Chance that U of two samples of a and b different values is at least u: orders are counted by a dynamic program.

    The number of orders with a certain U is a coefficient of the product of (1 - q^(b + i)) / (1 - q^i) for i up to a.
    """
    a, b = min(a, b), max(a, b)
    top = a * b
    ways = [1] + [0] * top
    for i in range(1, a + 1):
        for k in range(top, b + i - 1, -1):
            ways[k] -= ways[k - b - i]
        for k in range(i, top + 1):
            ways[k] += ways[k - i]
    u = max(0, u)
    return sum(ways[u:]) / math.comb(a + b, a)
