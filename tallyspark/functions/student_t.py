"""Two-sided p-value of a Pearson correlation, for the one-row fit results."""

from __future__ import annotations

import math

# The series below is exact to 1e-15 from here on; smaller arguments are raised to it.
_SERIES_FROM = 40.0
_MAX_STEPS = 10_000


def gamma_ratio(a: float) -> float:
    """Gamma(a + 1/2) / Gamma(a), without the large logarithms that cancel in it."""
    factor = 1.0
    while a < _SERIES_FROM:
        factor *= a / (a + 0.5)
        a += 1.0
    z = 1.0 / a
    series = 1 + z * (
        -1 / 8 + z * (1 / 128 + z * (5 / 1024 + z * (-21 / 32768 + z * (-399 / 262144 + z * 869 / 4194304))))
    )
    return factor * math.sqrt(a) * series


def _beta_fraction(a: float, b: float, x: float, y: float) -> float:
    """Continued fraction with I_x(a, b) = x^a y^b / (B(a, b) fraction), for y = 1 - x.

    Modified Lentz. It takes both x and y, so that neither is lost next to one.
    """
    tiny = 1e-300
    result = max(a * (a * y - b * x + 1) / (a + 1), tiny)
    c, d = result, 0.0
    for m in range(1, _MAX_STEPS):
        up = (a + m - 1) * (a + b + m - 1) * m * (b - m) * x * x / (a + 2 * m - 1) ** 2
        down = (
            m
            + m * (b - m) * x / (a + 2 * m - 1)
            + (a + m) * (a * y - b * x + 1 + m * (1 + y)) / (a + 2 * m + 1)
        )
        d = down + up * d
        c = down + up / c
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = c if abs(c) > tiny else tiny
        result *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return result
    raise ArithmeticError(f"the continued fraction at a={a}, b={b}, x={x} does not settle")


def correlation_p_value(r: float | None, n: int | None) -> float | None:
    """P(|T| >= |t|) with n - 2 degrees of freedom: I_x((n - 2) / 2, 1/2) at x = 1 - r^2."""
    if r is None or n is None or n < 2 or math.isnan(r):
        return None
    if n == 2:
        return 1.0 if r == 0.0 else 0.0
    r = abs(r)
    rest = (1.0 - r) * (1.0 + r)
    if rest <= 0.0:
        return 0.0
    if r == 0.0:
        return 1.0
    a = (n - 2) / 2.0
    log_rest = math.log1p(-r) + math.log1p(r)
    # x^a (1 - x)^(1/2) / B(a, 1/2)
    front = math.exp(a * log_rest) * r * gamma_ratio(a) / math.sqrt(math.pi)
    if rest < (a + 1.0) / (a + 2.5):
        return front / _beta_fraction(a, 0.5, rest, r * r)
    return 1.0 - front / _beta_fraction(0.5, a, r * r, rest)
