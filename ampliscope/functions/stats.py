"""Statistics as Column expressions; the t distribution's tail as an Arrow UDF, as there is no built-in."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def two_sided(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """The two-sided p of Student's t."""
    return pd.Series(np.array([two_sided(a, b) for a, b in zip(t, df)], dtype=float))


def welch_t(m1: Column, s1: Column, n1: Column, m2: Column, s2: Column, n2: Column) -> tuple[Column, Column]:
    """(t, degrees of freedom) for unequal variances; null under two values either side."""
    v1, v2 = s1 * s1 / n1, s2 * s2 / n2
    enough = (n1 >= 2) & (n2 >= 2)
    t = F.when(enough, F.try_divide(m1 - m2, F.sqrt(v1 + v2)))
    return t, F.when(enough, F.try_divide((v1 + v2) * (v1 + v2), v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1)))


def stars(p: Column) -> Column:
    return F.when(p.isNull() | F.isnan(p), "").when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def confidence_interval(mean: Column, sd: Column, n: Column) -> tuple[Column, Column]:
    half = 1.96 * sd / F.sqrt(n)
    return mean - half, mean + half


def swap_confidence(best: Column, expected: Column, least: float = 5.0) -> Column:
    return F.least(F.lit(0.5) + (best - expected - least) / (2 * least), F.lit(1.0))


def quantification_start(start: Column, end: Column, width: int) -> Column:
    return F.ceil(end - (end - start) / 2 - width / 2)
