"""Conversion recipes: text to number or timestamp with failures as NULL,
and numeric sentinel values to NULL (all row-local)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_numeric(col: Column) -> Column:
    """``pd.to_numeric(errors='coerce')``: NULL where the text is not a number."""
    return col.try_cast("double")


def to_datetime(col: Column, fmt: str | None = None) -> Column:
    """``pd.to_datetime(errors='coerce')``: NULL where the text is not a time."""
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def sentinel_to_null(col: Column, sentinels: Sequence[float]) -> Column:
    """Values used as codes for "missing" (e.g. -1, 9999) become NULL."""
    return F.when(~col.isin(list(sentinels)) | col.isNull(), col)
