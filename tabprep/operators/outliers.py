"""IQR outliers for every numeric column.

Quartiles of all columns come from ``quantiles.column_percentiles`` (a sketch,
then the values next to the ranks); their bounds, one row per column, are
literals of one more aggregate over the wide table that counts outliers and
takes the range.  No column's values are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns
from ..functions.numeric import safe_div
from ..functions.text import format_pct
from ..session import save_table, table_bytes
from .quantiles import BRACKET_BYTES, column_percentiles, exact_percentiles

METHODS = ("iqr",)


def _numeric_long(df: DataFrame, names: Sequence[str], key_cols: Sequence[str] = ()) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), c(n).cast("double").alias("value"))
                                for n in names])).alias("kv")
    return df.select(*[c(k) for k in key_cols], cells).select(*list(key_cols), "kv.column", "kv.value")


def _columns(df, include_columns, exclude_columns):
    return numeric_columns(df, include_columns, exclude_columns)


def _quartiles(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    """q1 and q3 of each column that has values (one row per column)."""
    return {r["column"]: (r["q1"], r["q3"]) for r in column_percentiles(df, names, [0.25, 0.75], ["q1", "q3"]).collect()}


def _fences(quartiles: tuple[float, float] | None, multiplier: float) -> tuple[float | None, float | None]:
    if quartiles is None:
        return None, None
    spread = multiplier * (quartiles[1] - quartiles[0])
    return quartiles[0] - spread, quartiles[1] + spread


def _outside(x, fences):
    return (x < F.lit(fences[0]).cast("double")) | (x > F.lit(fences[1]).cast("double"))


def _summary(df: DataFrame, names: Sequence[str], multiplier: float) -> DataFrame:
    """(column, q1, q3, lower_bound, upper_bound, actual_min, actual_max,
    n_rows, total_outliers): one aggregate, unpivoted afterwards."""
    quartiles = _quartiles(df, names)
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(names):
        x, own = c(name).cast("double"), quartiles.get(name)
        fences = _fences(own, float(multiplier))
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.count_if(_outside(x, fences)).alias(f"o{i}")]
        number = lambda v: F.lit(v).cast("double")
        rows.append(F.struct(
            F.lit(name).alias("column"), number(own and own[0]).alias("q1"), number(own and own[1]).alias("q3"),
            number(fences[0]).alias("lower_bound"), number(fences[1]).alias("upper_bound"), F.col(f"mn{i}").alias("actual_min"),
            F.col(f"mx{i}").alias("actual_max"), F.col("n").alias("n_rows"), F.col(f"o{i}").alias("total_outliers")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def iqr_bounds(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5,
               exclude_columns: Sequence[str] | None = None) -> DataFrame:
    """(column, q1, q3, iqr, lower_bound, upper_bound, actual_min, actual_max,
    n_rows) -- quartiles by linear interpolation over non-null values."""
    names = _columns(df, columns, exclude_columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, q3 double, iqr double, lower_bound double, "
                "upper_bound double, actual_min double, actual_max double, n_rows long")
    return _summary(df, names, multiplier).select("column", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"), "lower_bound",
                                                  "upper_bound", "actual_min", "actual_max", "n_rows")


def analyze_outliers(df: DataFrame, method: str = "iqr", iqr_multiplier: float = 1.5,
                     exclude_columns: Sequence[str] | None = None,
                     include_columns: Sequence[str] | None = None) -> DataFrame:
    """Per numeric column: outlier count (strictly outside the bounds), its
    percent of all rows (number and ``"12.3%"`` text), bounds and range.

    Three scans that read the analysed columns only: sketch, values next to
    the quartiles, counts.
    """
    if method not in METHODS:
        raise ValueError(f"Unsupported method: {method}. Currently only 'iqr' is supported.")
    names = _columns(df, include_columns, exclude_columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, total_outliers long, outlier_pct double, percentage string, q1 double, "
                "q3 double, lower_bound double, upper_bound double, actual_min double, actual_max double")
    pct = safe_div(F.col("total_outliers"), F.col("n_rows")) * F.lit(100.0)
    return _summary(df, names, iqr_multiplier).select(
        "column", F.col("total_outliers").cast("long").alias("total_outliers"), pct.alias("outlier_pct"),
        format_pct(F.round(pct, 1), 1).alias("percentage"), "q1", "q3", "lower_bound", "upper_bound", "actual_min", "actual_max")


def detect_outliers(df: DataFrame, column: str) -> DataFrame:
    """One column at the standard 1.5 x IQR."""
    return analyze_outliers(df, include_columns=[column]).select(
        "column", "total_outliers", "percentage", "lower_bound", "upper_bound")


def outlier_rows(df: DataFrame, key_cols: Sequence[str], columns: Sequence[str] | None = None,
                 iqr_multiplier: float = 1.5) -> DataFrame:
    """The outlying cells as (keys..., column, value); never collected."""
    names = _columns(df, columns, list(key_cols))
    quartiles = _quartiles(df, names) if names else {}
    found = []
    for name in names:
        x = c(name).cast("double")
        cell = F.struct(F.lit(name).alias("column"), x.alias("value"))
        found.append(F.when(_outside(x, _fences(quartiles.get(name), float(iqr_multiplier))), cell))
    cells = F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<column:string,value:double>>")
    return df.select(*[c(k) for k in key_cols], F.explode(cells).alias("__cell")).select(*[c(k) for k in key_cols], "__cell.column", "__cell.value")


def boxplot_stats(df: DataFrame, group_col: str, value_col: str, whisker: float = 1.5) -> DataFrame:
    """Per group: quartiles, whisker ends (the most extreme values inside the
    fences) and the number of fliers outside them."""
    keyed = df.where(c(group_col).isNotNull())
    q = exact_percentiles(keyed, value_col, [0.25, 0.5, 0.75], [group_col], ["q1", "median", "q3"])
    m = F.lit(float(whisker))
    fences = q.select(c(group_col), "q1", "median", "q3",
                      (F.col("q1") - m * (F.col("q3") - F.col("q1"))).alias("_lo"),
                      (F.col("q3") + m * (F.col("q3") - F.col("q1"))).alias("_hi"))
    x = c(value_col).cast("double")
    # one row per group: broadcast if its bytes allow, so that rows stay where they are
    fences = save_table(fences, "fences")
    fences = F.broadcast(fences) if table_bytes(fences) <= BRACKET_BYTES else fences
    joined = keyed.select(c(group_col), x.alias("_x")).where(F.col("_x").isNotNull()).join(fences, group_col)
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    return joined.groupBy(c(group_col)).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"))
