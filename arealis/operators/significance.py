"""Tail probabilities for regression tables: a handful of numbers per model, on the driver."""

from __future__ import annotations

import math

def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|)."""
    if math.isinf(t):
        return 0.0
    square = t * t
    return _regularized_beta(df / (df + square), square / (df + square), df / 2, 0.5)


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F >= f)."""
    if math.isinf(f):
        return 0.0
    whole = df2 + df1 * f
    return _regularized_beta(df2 / whole, df1 * f / whole, df2 / 2, df1 / 2)


def chi2_upper(x: float, df: int) -> float:
    """P(X >= x) for a whole number of degrees of freedom."""
    half = x / 2
    shape, tail = (0.5, math.erfc(math.sqrt(half))) if df % 2 else (1.0, math.exp(-half))
    while shape < df / 2:
        tail += math.exp(shape * math.log(half) - half - math.lgamma(shape + 1)) if half else 0.0
        shape += 1
    return tail


def t_critical(alpha: float, df: float) -> float:
    """The t with P(|T| >= t) = alpha, by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > alpha:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if t_two_sided(middle, df) > alpha else (low, middle)
    return (low + high) / 2


def omnibus(n: int, skewness: float, kurtosis: float) -> float | None:
    """D'Agostino and Pearson's statistic from the moments; about chi-square with 2 degrees. None under 8 values."""
    if n < 8:
        return None
    y = skewness * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (beta - 1)) - 1
    z_skew = math.asinh(y * math.sqrt((w2 - 1) / 2)) / math.sqrt(math.log(w2) / 2)
    mean = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurtosis - mean) / math.sqrt(variance)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / third * (2 / third + math.sqrt(1 + 4 / third**2))
    base = 1 + x * math.sqrt(2 / (a - 4))
    root = math.copysign((abs((1 - 2 / a) / base)) ** (1 / 3), base) if base else math.inf
    z_kurtosis = (1 - 2 / (9 * a) - root) / math.sqrt(2 / (9 * a))
    return z_skew**2 + z_kurtosis**2


def _log_gamma_ratio(a: float, b: float) -> float:
    """ln(Gamma(a + b) / Gamma(a)) without the loss of digits of a difference of two large numbers."""
    if a < 20:
        return math.lgamma(a + b) - math.lgamma(a)

    def rest(z: float) -> float:  # of Stirling's series
        return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z

    return (a + b - 0.5) * math.log1p(b / a) + b * math.log(a) - b + rest(a + b) - rest(a)


def _regularized_beta(x: float, y: float, a: float, b: float) -> float:
    """I_x(a, b) for y = 1 - x, by the continued fraction on the side where it converges fast."""
    if x <= 0 or y <= 0:
        return float(y <= 0)
    log_x = math.log(x) if x < 0.5 else math.log1p(-y)
    log_y = math.log(y) if y < 0.5 else math.log1p(-x)
    log_ratio = _log_gamma_ratio(a, b) - math.lgamma(b) if a > b else _log_gamma_ratio(b, a) - math.lgamma(a)
    front = math.exp(a * log_x + b * log_y + log_ratio)
    if x < (a + 1) / (a + b + 2):
        # The fraction loses the digits that x = 1 - y has lost; the series in y has them.
        other = front * _beta_series(y, b, a) / b if y < 0.5 and a * y < 100 * (1 + b) else 1.0
        return 1 - other if other < 0.999 else front * _beta_fraction(x, a, b) / a
    return 1 - front * _beta_fraction(y, b, a) / b


def _beta_series(x: float, a: float, b: float) -> float:
    """1 + (a+b)/(a+1) x + (a+b)(a+b+1)/((a+1)(a+2)) x² + …: positive terms only."""
    total = term = 1.0
    n = 0
    while term > 1e-17 * total:
        term *= (a + b + n) / (a + 1 + n) * x
        total += term
        n += 1
    return total


def _beta_fraction(x: float, a: float, b: float) -> float:
    """1/(1+ d1 x/(1+ d2 x/(1+ …))), evaluated forwards by Lentz's method.

    d(2m) = m (b-m) / ((a+2m-1)(a+2m)); d(2m+1) = -(a+m)(a+b+m) / ((a+2m)(a+2m+1)).
    """
    tiny = 1e-300
    value, upper, lower = 1.0, 1.0, 0.0
    for step in range(1, 100_000):
        m = step // 2
        if step % 2:
            d = -(a + m) * (a + b + m) / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) / ((a + 2 * m - 1) * (a + 2 * m))
        lower = 1 / ((1 + d * x * lower) or tiny)
        upper = (1 + d * x / upper) or tiny
        value *= upper * lower
        if abs(upper * lower - 1) < 1e-15:
            return 1 / value
    raise ArithmeticError(f"the beta fraction does not converge at {x}, {a}, {b}")
