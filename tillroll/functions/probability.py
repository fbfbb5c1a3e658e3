"""Normal quantiles and log-gamma as column arithmetic."""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of a published rational approximation of the
# inverse normal distribution (relative error below 1.2e-9).
A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
     1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
     6.680131188771972e01, -1.328068155288572e01)
C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
     -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
TAIL = 0.02425


def _horner(x: Column, coefficients, last: float | None = None) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out if last is None else out * x + last


def normal_quantile(p: Column) -> Column:
    """z with P(Z <= z) = p."""
    middle = p - 0.5
    square = middle * middle
    centre = _horner(square, A) * middle / _horner(square, B, 1.0)

    def tail(t: Column) -> Column:
        x = F.sqrt(-2 * F.log(t))
        return _horner(x, C) / _horner(x, D, 1.0)

    return F.when(p < TAIL, tail(p)).when(p > 1 - TAIL, -tail(1 - p)).otherwise(centre)


SHIFT = 8


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: shifted up, then Stirling's series."""
    below = F.lit(1.0)
    for i in range(SHIFT):
        below = below * (x + i)
    z = x + SHIFT
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def poisson_log_pmf(x: Column, rate: Column) -> Column:
    return x * F.log(rate) - rate - log_gamma(x + 1.0)


def negative_binomial_log_pmf(x: Column, size: Column, mu: Column) -> Column:
    return (
        log_gamma(x + size) - log_gamma(size) - log_gamma(x + 1.0)
        + size * F.log(size / (size + mu)) + x * F.log(mu / (size + mu))
    )


def _t_cdf(x: float, freedom: int) -> float:
    """Student's t distribution function for x >= 0 by Simpson's rule."""
    scale = math.exp(math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2)) / math.sqrt(freedom * math.pi)
    n = 2000
    step = x / n
    total = sum(
        (1 if i in (0, n) else 4 if i % 2 else 2) * (1 + (i * step) ** 2 / freedom) ** (-(freedom + 1) / 2)
        for i in range(n + 1)
    )
    return 0.5 + scale * total * step / 3


@cache
def t90_table() -> tuple[float, ...]:
    """90% points of Student's t for 1 to 30 degrees of freedom, by bisection."""
    out = []
    for freedom in range(1, 31):
        low, high = 1.0, 4.0
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if _t_cdf(middle, freedom) < 0.9 else (low, middle)
        out.append((low + high) / 2)
    return tuple(out)


def student_t90(freedom: Column) -> Column:
    """90% point of Student's t; from 31 degrees of freedom on by its series in 1 / freedom."""
    z = 1.2815515655446004
    terms = ((z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384)
    far = F.lit(z)
    for i, term in enumerate(terms, 1):
        far = far + term / F.pow(F.nullif(freedom, F.lit(0)), i)
    table = F.array(*[F.lit(v) for v in t90_table()])
    return F.when(freedom <= 30, F.get(table, freedom - 1)).otherwise(far)
