"""Tail probabilities of test statistics; scalars on the driver."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
_LARGE = 1e4


def _log_beta(a: float, b: float) -> float:
    """log B(a, b) that keeps its digits when one argument is large.

    With one large argument the difference of its two log gammas is taken from Stirling's series,
    whose leading terms are subtracted by hand.
    """
    a, b = min(a, b), max(a, b)
    if b < _LARGE:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)

    def rest(z: float) -> float:
        return sum(c / z ** (2 * i + 1) for i, c in enumerate(_STIRLING))

    # lgamma(b) - lgamma(a + b) = (b - 1/2) log(b / (a + b)) - a log(a + b) + a + ...
    gap = -(b - 0.5) * math.log1p(a / b) - a * math.log(a + b) + a + rest(b) - rest(a + b)
    return math.lgamma(a) + gap if a < _LARGE else (
        (a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi) + rest(a) + gap
    )


def beta_regularised(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction.

    Raises ``ArithmeticError`` if the fraction does not settle.
    """
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_regularised(1.0 - x, b, a)
    log_front = a * math.log(x) + b * math.log1p(-x) - _log_beta(a, b)
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    total = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        step = 1.0
        for coef in (even, odd):
            d = 1.0 + coef * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + coef / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-15:
            break
    else:
        raise ArithmeticError(f"no limit found for the beta function at {x}, {a}, {b}")
    return math.exp(log_front) * total / a


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    if f <= 0:
        return 1.0
    if df1 == 1.0 and df2 >= 1e6 and f < df2**0.5:
        return t_two_sided(math.sqrt(f), df2)
    return beta_regularised(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|); for large ``df`` by the expansion of t about the normal distribution."""
    if df < 1e6:
        return f_upper(t * t, 1.0, df)
    t = abs(t)
    z = t * (1 - (t * t + 1) / (4 * df) + (13 * t**4 + 8 * t * t + 3) / (96 * df * df))
    return normal_two_sided(z) if t * t < df**0.5 else f_upper(t * t, 1.0, df)
