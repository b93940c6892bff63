"""Upper tail probabilities for test statistics, for the few rows of a ranking."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _gamma_tail(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below the mean, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - front * total)
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def _beta_part(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by numerical continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_part(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    c, d = 1.0, 1 / max(1e-300, 1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 2000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_tail(statistic: float, dof: float) -> float:
    return _gamma_tail(dof / 2, statistic / 2)


def f_tail(statistic: float, dof1: float, dof2: float) -> float:
    return _beta_part(dof2 / 2, dof1 / 2, dof2 / (dof2 + dof1 * statistic)) if statistic > 0 else 1.0


def r_tail(r: float, n: float) -> float:
    """Two-sided p-value of a Pearson correlation of n pairs."""
    if n < 3:
        return 1.0
    return 0.0 if abs(r) >= 1 else f_tail(r * r * (n - 2) / (1 - r * r), 1, n - 2)


def as_column(tail, *inputs: Column) -> Column:
    """Apply a tail function to the columns of a small result."""

    @F.pandas_udf("double")
    def apply(frame: pd.DataFrame) -> pd.Series:
        return pd.Series([None if any(pd.isna(v) for v in row) else tail(*row) for row in frame.itertuples(index=False)], dtype="float64")

    return apply(F.struct(*[c.cast("double") for c in inputs]))
