"""Upper tail of the F distribution (no statistics package is assumed)."""

from math import exp, lgamma, log


def _beta_fraction(a: float, b: float, x: float, limit: int = 10_000) -> float:
    """Continued fraction of the incomplete beta function, evaluated forwards (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, limit):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-14:
            return value
    raise ArithmeticError(f"the tail at {a}, {b}, {x} did not converge")


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def f_upper_tail(f: float, df: float, error_df: float) -> float:
    return beta_share(error_df / 2, df / 2, error_df / (error_df + df * f))
