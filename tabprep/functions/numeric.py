"""Numeric column expressions that respect ANSI mode (no raising on /0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def clip(col: Column, lo: float, hi: float) -> Column:
    """``least(greatest(x, lo), hi)`` but NULL stays NULL
    (``least``/``greatest`` skip nulls)."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(lo)), F.lit(hi)))


def round2(col: Column) -> Column:
    return F.round(col, 2)


def dbl(x: float) -> Column:
    """A double literal (a bare Python float would be fine, but decimal
    literals in SQL text are not, so operators build literals through here)."""
    return F.lit(float(x)).cast("double")
