"""Distribution functions: the normal CDF as a column expression, and p-values.

The p-value functions run over finished test results (one row per test), so they
are small pandas UDFs; the normal CDF is applied per row of data and therefore
stays inside the JVM.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Coefficients of the rational approximations to erf and erfc
# published by W. J. Cody, Math. Comp. 23 (1969), 631-637.
ERF_NUM = [3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02, 3.16112374387056560e00, 1.85777706184603153e-1]
ERF_DEN = [2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02, 2.36012909523441209e01, 1.0]
ERFC_MID_NUM = [
    1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03, 8.81952221241769090e02, 2.98635138197400131e02,
    6.61191906371416295e01, 8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8,
]
ERFC_MID_DEN = [
    1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03, 3.29079923573345963e03, 1.62138957456669019e03,
    5.37181101862009858e02, 1.17693950891312499e02, 1.57449261107098347e01, 1.0,
]
ERFC_FAR_NUM = [
    6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1, 3.60344899949804439e-1, 3.05326634961232344e-1,
    1.63153871373020978e-2,
]
ERFC_FAR_DEN = [
    2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1, 1.87295284992346725e00, 2.56852019228982242e00, 1.0,
]


def _poly(x: Column, coefficients: list[float]) -> Column:
    total = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        total = total * x + F.lit(c)
    return total


def erfc(x: Column) -> Column:
    """Complementary error function, about 15 digits, as a JVM expression."""
    a = F.abs(x)
    square = a * a
    near = F.lit(1.0) - a * _poly(square, ERF_NUM) / _poly(square, ERF_DEN)
    middle = F.exp(-square) * _poly(a, ERFC_MID_NUM) / _poly(a, ERFC_MID_DEN)
    inverse = F.lit(1.0) / square
    tail = inverse * _poly(inverse, ERFC_FAR_NUM) / _poly(inverse, ERFC_FAR_DEN)
    far = F.exp(-square) / a * (F.lit(1.0 / math.sqrt(math.pi)) - tail)
    positive = F.when(a <= 0.46875, near).when(a <= 4.0, middle).otherwise(far)
    return F.when(x < 0, F.lit(2.0) - positive).otherwise(positive)


def normal_cdf(x: Column, mean: Column | float = 0.0, sd: Column | float = 1.0) -> Column:
    """P(X ≤ x) for a normal variable."""
    z = (x - mean) / sd if isinstance(mean, Column) or isinstance(sd, Column) else (x - F.lit(mean)) / F.lit(sd)
    return F.lit(0.5) * erfc(-z / F.lit(math.sqrt(2.0)))


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above."""
    if not (a > 0 and x >= 0):
        return math.nan
    if x == 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - scale * total)
    b = x + 1 - a
    c = 1e300
    d = h = 1 / b
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or 1e-300)
        c = b + step / c or 1e-300
        change = c * d
        h *= change
        if abs(change - 1) < 1e-16:
            break
    return scale * h


def _beta_lower(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta I_x(a, b) by Lentz's continued fraction."""
    if math.isnan(x) or math.isnan(a) or math.isnan(b):
        return math.nan
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_lower(1 - x, b, a)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    c = 1.0
    d = 1 / (1 - (a + b) * x / (a + 1) or 1e-300)
    h = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d or 1e-300)
        c = 1 + even / c or 1e-300
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d or 1e-300)
        c = 1 + odd / c or 1e-300
        change = d * c
        h *= change
        if abs(change - 1) < 1e-16:
            break
    return scale * h / a


def _kolmogorov_upper(d: float, n: float) -> float:
    """P(D_n ≥ d): exact matrix power up to n = 140, then the limit law with its terms to n^(−3/2).

    The expansion is that of Pelz and Good (1976) in the form given by Simard and
    L'Ecuyer (2011), whose error is below 1e-6 there.
    """
    if math.isnan(d) or n <= 0:
        return math.nan
    if d <= 0 or d >= 1:
        return 1.0 if d <= 0 else 0.0
    if n <= 140:
        n = int(n)
        k = math.ceil(n * d)
        size = 2 * k - 1
        h = k - n * d
        grid = np.subtract.outer(np.arange(size), np.arange(size)) + 1
        base = np.where(grid >= 0, 1.0, 0.0)
        powers = h ** np.arange(1, size + 1)
        base[:, 0] -= powers
        base[-1, :] -= powers[::-1]
        base[-1, 0] += max(2 * h - 1, 0.0) ** size
        base *= np.array([[math.exp(-math.lgamma(max(g, 0) + 1)) for g in row] for row in grid.tolist()])
        power = np.linalg.matrix_power(base / math.e, n)[k - 1, k - 1]
        below = power * math.exp(math.lgamma(n + 1) - n * math.log(n) + n)
        return min(1.0, max(0.0, 1.0 - below))
    root = math.sqrt(n)
    z = root * d
    if z < 0.05:
        return 1.0
    k = np.arange(-200, 200)
    odd, even = (math.pi * (k + 0.5)) ** 2, (math.pi * k) ** 2
    at_odd, at_even = np.exp(-odd / (2 * z * z)), np.exp(-even / (2 * z * z))
    half = math.sqrt(math.pi / 2)
    limit = half / z * at_odd.sum()
    first = half / (6 * z**4) * ((odd - z**2) * at_odd).sum()
    second = half / (72 * z**7) * (
        ((6 * z**6 + 2 * z**4) + (2 * z**4 - 5 * z**2) * odd + (1 - 2 * z**2) * odd**2) * at_odd
    ).sum() - half / (36 * z**3) * (even * at_even).sum()
    third = half / (6480 * z**10) * (
        (
            -30 * z**6
            - 90 * z**8
            + (135 * z**4 - 96 * z**6) * odd
            + (212 * z**4 - 60 * z**2) * odd**2
            + (5 - 30 * z**2) * odd**3
        )
        * at_odd
    ).sum() + half / (216 * z**6) * ((3 * even * z**2 - even**2) * at_even).sum()
    return min(1.0, max(0.0, 1.0 - (limit + first / root + second / n + third / (n * root))))


@F.pandas_udf(DoubleType())
def chi2_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([1.0 if k == 0 else _gamma_upper(k / 2.0, s / 2.0) for s, k in zip(statistic, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def student_t_p_value(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([_beta_lower(k / (k + t * t), k / 2.0, 0.5) for t, k in zip(statistic, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def kolmogorov_p_value(statistic: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([_kolmogorov_upper(d, k) for d, k in zip(statistic, n)], dtype="float64")
