"""Survival function of the F distribution.

Used for the one-way ANOVA p-value.  The statistic itself is computed by a
distributed aggregate; what remains is one scalar per test, evaluated inside
a task by a vectorised (Arrow) pandas UDF so the plan stays lazy.

sf(F; d1, d2) = I_x(d2/2, d1/2) with x = d2 / (d2 + d1 F), the regularised
incomplete beta function, evaluated by the modified Lentz continued fraction
(Numerical Recipes §6.4).  For very large d2 the F distribution is d1 times
a chi-square; then Q(d1/2, d1 F / 2), the regularised upper incomplete
gamma, is used (§6.2), which avoids the slow convergence of the fraction.
"""

from __future__ import annotations

import math

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ship this module's code with the UDF (by value), so executors need no
# copy of the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_EPS = 1e-15
_TINY = 1e-300
_MAXIT = 100_000


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, _MAXIT + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _betacf(a, b, x) / a
    ln_back = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
               + b * math.log1p(-x) + a * math.log(x))
    return 1.0 - math.exp(ln_back) * _betacf(b, a, 1.0 - x) / b


def gammaincc(s: float, t: float) -> float:
    """Regularised upper incomplete gamma Q(s, t)."""
    if t <= 0.0:
        return 1.0
    ln_front = -t + s * math.log(t) - math.lgamma(s)
    if t < s + 1.0:
        term = total = 1.0 / s
        ap = s
        for _ in range(_MAXIT):
            ap += 1.0
            term *= t / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return 1.0 - total * math.exp(ln_front)
    b = t + 1.0 - s
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, _MAXIT + 1):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1.0) < _EPS:
            break
    return math.exp(ln_front) * h


def f_sf(f: float | None, d1: float | None, d2: float | None) -> float | None:
    """P(X > f) for X ~ F(d1, d2); None when undefined."""
    if f is None or d1 is None or d2 is None:
        return None
    if any(isinstance(v, float) and math.isnan(v) for v in (f, d1, d2)):
        return None
    if d1 <= 0 or d2 <= 0:
        return None
    if f <= 0:
        return 1.0
    if math.isinf(f):
        return 0.0
    if d2 > 1e7:
        return gammaincc(d1 / 2.0, d1 * f / 2.0)
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(T.DoubleType())
def f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Column form of ``f_sf`` (one value per test row, so Python cost is
    per test, not per data row)."""
    out = [f_sf(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b),
                None if pd.isna(c) else float(c)) for a, b, c in zip(f, d1, d2)]
    return pd.Series(out, dtype="float64")
