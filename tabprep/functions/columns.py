"""Column selection, quoting and the null rule.

Every operator resolves its column arguments through these helpers so the
behaviour is uniform: requested names that are unknown or of the wrong type
family are silently ignored, ``include`` wins over ``exclude``, and names
with dots work because every reference goes through ``c``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
            T.FloatType, T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_STRING = (T.StringType, T.CharType, T.VarcharType)


def c(name: str) -> Column:
    """Column reference that survives dots and other odd characters."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_numeric(dt: T.DataType) -> bool:
    # boolean is deliberately not numeric
    return isinstance(dt, _NUMERIC)


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, _INTEGRAL)


def is_string(dt: T.DataType) -> bool:
    return isinstance(dt, _STRING)


def is_floating(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def _family(df: DataFrame, pred) -> list[str]:
    return [f.name for f in df.schema.fields if pred(f.dataType)]


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None,
                    exclude: Iterable[str] | None = None) -> list[str]:
    return select_columns(df, is_numeric, columns, exclude)


def integral_columns(df: DataFrame, columns: Sequence[str] | None = None,
                     exclude: Iterable[str] | None = None) -> list[str]:
    return select_columns(df, is_integral, columns, exclude)


def string_columns(df: DataFrame, columns: Sequence[str] | None = None,
                   exclude: Iterable[str] | None = None) -> list[str]:
    return select_columns(df, is_string, columns, exclude)


def select_columns(df: DataFrame, pred, columns: Sequence[str] | None = None,
                   exclude: Iterable[str] | None = None) -> list[str]:
    """Columns of one type family.

    ``columns`` (when non-empty) restricts and orders the result; names not
    in the family are dropped without error.  ``exclude`` applies only when
    ``columns`` is empty.
    """
    family = _family(df, pred)
    if columns:
        allowed = set(family)
        return [col for col in columns if col in allowed]
    skip = set(exclude or ())
    return [col for col in family if col not in skip]


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Normalise float NaN to SQL NULL (pandas has a single missing value)."""
    targets = set(select_columns(df, is_floating, columns))
    if not targets:
        return df
    return df.select([
        F.when(~F.isnan(c(f.name)), c(f.name)).alias(f.name) if f.name in targets else c(f.name)
        for f in df.schema.fields
    ])


def validate_columns(df: DataFrame, required: Sequence[str]) -> tuple[bool, list[str]]:
    """(all present?, missing names in the required order)."""
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    return (not missing, missing)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[col for col in columns if col in df.columns])


def long_form(df: DataFrame, result: str, metrics: Sequence[str], label: Column | None = None, at: Column | None = None) -> DataFrame:
    """(result, label, at, metric, value): the named columns of a result table
    as rows, so that tables of any shape can be put together.  ``label`` says
    which row of the table it is, ``at`` where on a scale."""
    number = lambda m: F.when(c(m), 1.0).otherwise(0.0) if isinstance(df.schema[m].dataType, T.BooleanType) else c(m).cast("double")
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), number(m).alias("value")) for m in metrics])).alias("x")
    label = F.lit(None) if label is None else label
    at = F.lit(None) if at is None else at
    return df.select(F.lit(result).alias("result"), label.cast("string").alias("label"), at.cast("double").alias("at"), cells).select("result", "label", "at", "x.metric", "x.value")
