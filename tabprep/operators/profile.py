"""Column profiles: null / placeholder / blank counts, unique values,
min-max, value counts, crosstabs, column info.

All per-column counts of one table come from a single aggregate and are
returned long (one row per column) via ``unpivot`` -- never a Python loop of
jobs.  Unique-value lists use a two-stage top-k so no column's distinct
values are ranked in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.columns import c, integral_columns, string_columns
from ..functions.numeric import safe_div
from ..functions.text import DEFAULT_MISSING_VALUES, strip
from ..session import save_table

# spread each column's distinct values over this many buckets before ranking
_TOPK_SALT = 1024


def _long(df: DataFrame, names: Sequence[str], value_name: str) -> DataFrame:
    """Unpivot a one-row frame with columns ``_0 .. _n`` into (column, value)."""
    return df.unpivot([], [f"_{i}" for i in range(len(names))], "_k", value_name).select(
        F.element_at(F.array(*[F.lit(n) for n in names]),
                     F.substring("_k", 2, 10).cast("int") + 1).alias("column"), value_name)


def null_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column (NaN counts as missing in float columns)."""
    names = df.columns
    if not names:
        return df.sparkSession.createDataFrame([], "column string, null_count long")
    aggs = []
    for i, name in enumerate(names):
        miss = c(name).isNull()
        if df.schema[name].dataType.typeName() in ("double", "float"):
            miss = miss | F.isnan(c(name))
        aggs.append(F.count_if(miss).alias(f"_{i}"))
    return _long(df.agg(*aggs), names, "null_count")


def bad_value_counts(df: DataFrame, tokens: Sequence[str] = DEFAULT_MISSING_VALUES,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column, cells whose stripped text is a placeholder token
    (NULL cells are not counted)."""
    names = string_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, bad_count long")
    aggs = [F.count_if(strip(c(n)).isin(list(tokens))).alias(f"_{i}") for i, n in enumerate(names)]
    return _long(df.agg(*aggs), names, "bad_count")


def whitespace_only_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column, cells that are empty after stripping."""
    names = string_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, blank_count long")
    aggs = [F.count_if(strip(c(n)) == "").alias(f"_{i}") for i, n in enumerate(names)]
    return _long(df.agg(*aggs), names, "blank_count")


def min_max_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """min and max of each integer column, as (column, min, max) sorted by max."""
    names = integral_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, min long, max long")
    row = df.agg(*[F.struct(F.min(c(n)).cast("long").alias("min"),
                            F.max(c(n)).cast("long").alias("max")).alias(f"_{i}")
                   for i, n in enumerate(names)])
    return _long(row, names, "mm").select("column", "mm.min", "mm.max").orderBy("max", "column")


def _string_long(df: DataFrame, names: Sequence[str], order_col: str | None) -> DataFrame:
    """(column, value, ord) for every string cell; nulls kept.  Without an
    order column the position is a constant (row order is not stable under
    recomputation, so first-seen lists always need an explicit key)."""
    ordk = c(order_col) if order_col else F.lit(0)
    return df.select(ordk.alias("_ord"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).alias("value")) for n in names])).alias("kv")
    ).select("kv.column", "kv.value", "_ord")


def unique_values(df: DataFrame, order_col: str | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column: distinct count (NULL counted as a value), most
    frequent non-null value and its count (ties: smallest value).

    One ``groupBy(column, value)`` (map-side combined) feeds both numbers;
    the top value is a ``max_by`` -- no sort.
    """
    names = string_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, n_unique long, top_value string, top_count long")
    per = _string_long(df, names, order_col).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    # ranking (count desc, value asc) is a total order, so the top value is
    # the minimum of (-count, value) over non-null values; one aggregate
    key = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v")))
    return per.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"), F.min(key).alias("_best")).select(
        "column", "n_unique", F.col("_best.v").alias("top_value"), (-F.col("_best.neg_n")).alias("top_count"))


def first_seen_values(df: DataFrame, order_col: str, max_unique: int = 50,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """The first ``max_unique`` distinct values of each string column in
    order of first appearance (by ``order_col``), NULL included as a value:
    (column, position, value).

    Two-stage top-k: distinct values are keyed by their first position, a
    salted ``row_number`` keeps at most ``max_unique`` per (column, salt)
    bucket, and only those survivors are ranked per column.
    """
    names = string_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, position int, value string")
    first = _string_long(df, names, order_col).groupBy("column", "value").agg(
        F.min("_ord").alias("_first"))
    salt = F.pmod(F.xxhash64("value"), F.lit(_TOPK_SALT))
    w1 = Window.partitionBy("column", "_salt").orderBy("_first")
    pre = (first.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1))
           .where(F.col("_r") <= max_unique))
    w2 = Window.partitionBy("column").orderBy("_first")
    return (pre.withColumn("position", F.row_number().over(w2)).where(F.col("position") <= max_unique)
            .select("column", "position", "value"))


def distinct_values(df: DataFrame, order_col: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every distinct value of each string column (NULL included) with its
    position in order of first appearance: (column, position, value).

    The full list, uncapped: positions are running counts over the distinct
    values ordered by their first key, computed with the range-bucketed
    ``running_totals`` (a single window per column would put a
    high-cardinality column in one task).
    """
    from .cumulative import running_totals
    names = string_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, position long, value string")
    first = _string_long(df, names, order_col).groupBy("column", "value").agg(
        F.min("_ord").alias("_first"), F.lit(1).alias("_one"))
    ranked = running_totals(first, "_first", ["_one"], ["column"])
    return ranked.select("column", F.col("cum__one").cast("long").alias("position"), "value")


def value_counts_pct(df: DataFrame, col: str) -> DataFrame:
    """Count per value (NULL dropped) and its percent of **all** rows."""
    # the denominator is one scalar (all rows, NULL included); the per-value
    # table may be large, so it is not windowed into one task
    total = df.agg(F.count(F.lit(1))).first()[0]
    counts = df.where(c(col).isNotNull()).groupBy(c(col)).agg(F.count(F.lit(1)).alias("count"))
    return counts.select(c(col), "count",
                         (safe_div(F.col("count"), F.lit(total)) * F.lit(100.0)).alias("percent"))


def column_info(df: DataFrame, sample: int = 3, order_col: str | None = None) -> DataFrame:
    """One row per column: name, type, position, table row/column counts,
    and the first ``sample`` values of string columns (by ``order_col``)."""
    spark = df.sparkSession
    n_rows = F.count(F.lit(1))
    names = string_columns(df)
    samples = {}
    if names:
        ordered = df.orderBy(c(order_col)) if order_col else df
        head = ordered.select(*[c(n) for n in names]).limit(sample)  # a fixed-size head
        samples = {n: [r[i] for r in head.collect()] for i, n in enumerate(names)}
    rows = df.agg(n_rows.alias("n")).first()["n"]
    data = [(f.name, i, f.dataType.simpleString(), rows, len(df.columns),
             samples.get(f.name)) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(data, "column string, position int, type string, n_rows long, "
                                       "n_columns int, sample array<string>")


def half_open_range(df: DataFrame, key_col: str, from_val=None, to_val=None) -> DataFrame:
    """Rows with ``from < key <= to``; ``key > from`` when ``to`` is None;
    no filter when ``from`` is None (``to`` alone is ignored)."""
    if from_val is None:
        return df
    cond = c(key_col) > F.lit(from_val)
    if to_val is not None:
        cond = cond & (c(key_col) <= F.lit(to_val))
    return df.where(cond)


def crosstab(df: DataFrame, col1: str, col2: str, from_val=None, to_val=None, dense: bool = False) -> DataFrame:
    """Contingency counts in long form (col1, col2, count), NULL keys dropped,
    optional half-open range on col1; both columns keep their types.

    ``dense=True`` adds a row with 0 for each absent combination, as the
    matrix form has: every col1 value with the list of col2 values.  That
    output has as many rows as the product, so ask for it only where col2 is
    a category.
    """
    keyed = half_open_range(df, col1, from_val, to_val).where(
        c(col1).isNotNull() & c(col2).isNotNull()).select(c(col1).alias("_r"), c(col2).alias("_c"))
    counts = keyed.groupBy("_r", "_c").agg(F.count(F.lit(1)).alias("count"))
    if dense:
        counts = save_table(counts, "crosstab")
        kind = counts.schema["_c"].dataType
        values = [F.lit(r["_c"]).cast(kind) for r in counts.select("_c").distinct().collect()]  # the categories of col2
        zeros = counts.select("_r").distinct().select("_r", F.explode(F.array(*values) if values else F.array().cast(ArrayType(kind))).alias("_c"))
        counts = counts.unionByName(zeros.withColumn("count", F.lit(0).cast("long"))).groupBy("_r", "_c").agg(F.sum("count").alias("count"))
    return counts.select(F.col("_r").alias(col1), F.col("_c").alias(col2), "count")


def crosstab_wide(df: DataFrame, col1: str, col2: str) -> DataFrame:
    """The crosstab as a matrix: one row per col1 value, one column per col2
    value."""
    keyed = df.where(c(col1).isNotNull() & c(col2).isNotNull())
    return keyed.groupBy(c(col1)).pivot(col2).count().na.fill(0)


def crosstab_total(df: DataFrame, col1: str, col2: str, from_val=None, to_val=None) -> DataFrame:
    """Column sums of the (range-filtered) crosstab: (col2, total)."""
    keyed = half_open_range(df, col1, from_val, to_val).where(
        c(col1).isNotNull() & c(col2).isNotNull())
    return keyed.groupBy(c(col2)).agg(F.count(F.lit(1)).alias("total"))
