"""Text and numeric cleaning.

``clean_object_columns`` is one projection (no action).  The numeric fills
compute every statistic they need in a single aggregate pass and then apply
it as literals in one projection, so cleaning N columns costs one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, is_integral, nan_to_null, numeric_columns, string_columns
from ..functions.text import (DEFAULT_MISSING_VALUES, normalize_spaces, strip,
                              title_case)


class CaseStyle(Enum):
    ORIGINAL = "original"
    TITLE = "title"
    UPPER = "upper"
    LOWER = "lower"


class FillStrategy(Enum):
    NONE = "none"
    DROP = "drop"
    MEAN = "mean"
    MEDIAN = "median"
    MODE = "mode"
    ZERO = "zero"
    VALUE = "value"


def _apply_case(col: Column, style: CaseStyle) -> Column:
    if style == CaseStyle.TITLE:
        return title_case(col)
    if style == CaseStyle.UPPER:
        return F.upper(col)
    if style == CaseStyle.LOWER:
        return F.lower(col)
    return col


def clean_text(col: Column, missing_values: Sequence[str] = DEFAULT_MISSING_VALUES,
               replacement: str | None = None, case_style: CaseStyle = CaseStyle.ORIGINAL,
               strip_whitespace: bool = True, collapse_spaces: bool = False) -> Column:
    """One string column through strip -> token replacement -> case -> spaces.

    With stripping on, a NULL cell counts as missing (it receives
    ``replacement``), as does any stripped value in ``missing_values``.
    Without stripping, NULL stays NULL.  Case and space collapsing apply to
    the replacement text as well, because they run after it.
    """
    out = strip(col) if strip_whitespace else col
    missing = out.isin(list(missing_values))
    if strip_whitespace:
        missing = missing | col.isNull()
    repl = F.lit(replacement).cast("string") if replacement is not None else F.lit(None).cast("string")
    out = F.when(missing, repl).otherwise(out)
    out = _apply_case(out, case_style)
    if collapse_spaces:
        out = normalize_spaces(out)
    return out


def clean_object_columns(df: DataFrame, columns: Sequence[str] | None = None,
                         missing_values: Sequence[str] = DEFAULT_MISSING_VALUES,
                         replacement: str | None = None,
                         case_style: CaseStyle = CaseStyle.ORIGINAL,
                         column_case_styles: Mapping[str, CaseStyle] | None = None,
                         strip_whitespace: bool = True,
                         normalize_spaces: bool = False) -> DataFrame:
    """Clean string columns; other columns pass through unchanged (row-local,
    valid on a streaming DataFrame)."""
    targets = set(string_columns(df, columns))
    if not targets:
        return df
    per_col = dict(column_case_styles or {})
    exprs = []
    for name in df.columns:
        if name in targets:
            exprs.append(clean_text(c(name), missing_values, replacement,
                                    per_col.get(name, case_style), strip_whitespace,
                                    normalize_spaces).alias(name))
        else:
            exprs.append(c(name))
    return df.select(exprs)


def numeric_fill_values(df: DataFrame, columns: Sequence[str], strategy: FillStrategy,
                        exact: bool = True) -> dict[str, float | None]:
    """Per-column fill statistic for all columns at once.

    MEAN: one aggregate.  MEDIAN: exact by default, by a bracket around it
    (``quantiles``); ``exact=False`` uses the one-pass
    ``percentile_approx`` sketch instead.  MODE: the smallest most-frequent
    value.
    """
    if not columns:
        return {}
    df = nan_to_null(df)
    if strategy == FillStrategy.MODE:
        return _mode_values(df, columns)
    if strategy == FillStrategy.MEDIAN and exact:
        return _median_values(df, columns)
    aggs = []
    for i, name in enumerate(columns):
        x = c(name).cast("double")
        if strategy == FillStrategy.MEAN:
            aggs.append(F.avg(x).alias(f"s{i}"))
        else:
            aggs.append(F.percentile_approx(x, 0.5, 100_000).cast("double").alias(f"s{i}"))
    row = df.agg(*aggs).first()
    return {name: row[f"s{i}"] for i, name in enumerate(columns)}


def _median_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of all columns together; one row per column is collected."""
    from .quantiles import column_percentiles
    med = {r["column"]: r["median"] for r in column_percentiles(df, columns, [0.5], ["median"]).collect()}
    return {name: med.get(name) for name in columns}


def _mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Mode of every column in one pass.

    The columns of one type are unpivoted to (column, value) and counted per
    pair in that type, so partial aggregation collapses repeats before the
    shuffle and long integers keep all digits; the winner per column is the
    smallest (-count, value) -- no global sort, one job per column type.
    """
    by_type: dict[str, list[int]] = {}
    for i, name in enumerate(columns):
        by_type.setdefault(df.schema[name].dataType.simpleString(), []).append(i)
    found = {}
    for own in by_type.values():
        long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("k"), c(columns[i]).alias("v")) for i in own])).alias("kv")).select("kv.k", "kv.v")
        counts = long.where(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count("*").alias("n"))
        best = counts.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b"))
        found |= {r["k"]: r["v"] for r in best.select("k", "b.v").collect()}  # at most one row per column
    return {name: found.get(i) for i, name in enumerate(columns)}


def clean_numeric_columns(df: DataFrame, columns: Sequence[str] | None = None,
                          strategy: FillStrategy = FillStrategy.NONE,
                          fill_value: float | None = None, exact: bool = True) -> DataFrame:
    """Fill or drop missing values of numeric columns."""
    targets = numeric_columns(df, columns)
    if not targets or strategy == FillStrategy.NONE:
        return df
    df = nan_to_null(df, targets)
    if strategy == FillStrategy.DROP:
        return df.na.drop("any", subset=targets)
    if strategy == FillStrategy.VALUE and fill_value is None:
        raise ValueError("fill_value must be provided when using FillStrategy.VALUE")
    if strategy in (FillStrategy.ZERO, FillStrategy.VALUE):
        value = 0 if strategy == FillStrategy.ZERO else fill_value
        fills = {name: value for name in targets}
    else:
        fills = numeric_fill_values(df, targets, strategy, exact)
    return apply_fills(df, fills, as_double=strategy in (FillStrategy.MEAN, FillStrategy.MEDIAN))


def apply_fills(df: DataFrame, fills: Mapping[str, float | None], as_double: bool = False) -> DataFrame:
    """``coalesce(col, literal)`` per column; a NULL statistic (all-null
    column) leaves the column alone.  Row-local: the fitted ``fills`` can be
    applied to a streaming DataFrame.  NaN counts as missing."""
    df, exprs = nan_to_null(df, list(fills)) if fills else df, []
    for name in df.columns:
        v = fills.get(name)
        if name in fills and v is not None:
            kind = filled_type(df, name, v, as_double)
            exprs.append(F.coalesce(c(name).cast(kind), F.lit(v).cast(kind)).alias(name))
        else:
            exprs.append(c(name))
    return df.select(exprs)


_INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def filled_type(df: DataFrame, name: str, value, as_double: bool) -> str:
    """The column's type, widened where the fill value does not fit: a
    fraction makes an integer column double, a large integer makes it bigint."""
    kind = df.schema[name].dataType
    if as_double:
        return "double"
    if is_integral(kind):
        if value != int(value):
            return "double"
        if not -(1 << _INTEGER_BITS[kind.simpleString()] - 1) <= int(value) < 1 << _INTEGER_BITS[kind.simpleString()] - 1:
            return "bigint" if -(1 << 63) <= int(value) < 1 << 63 else "double"
    elif kind.simpleString().startswith("decimal") and round(float(value), kind.scale) != float(value):
        return "double"
    return kind.simpleString()


def drop_na_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return clean_numeric_columns(df, columns, FillStrategy.DROP)


def clean_dataframe(df: DataFrame, object_config: Mapping | None = None,
                    numeric_config: Mapping | None = None) -> DataFrame:
    """Text cleaning first, then numeric filling; a ``None`` config skips
    that half."""
    out = df
    if object_config is not None:
        out = clean_object_columns(out, **object_config)
    if numeric_config is not None:
        out = clean_numeric_columns(out, **numeric_config)
    return out
