"""Pearson correlation, high-correlation pairs and correlation pruning.

All column pairs come from one aggregate after one for the means
(pairwise-complete: each pair uses the rows where both values are present).  r = cov / (sd_a sd_b) with
``nullif``, so a constant column yields NULL instead of the ANSI
divide-by-zero that the built-in ``corr`` raises.  The result is a long
table (a, b, r) of d^2 rows -- it grows with the column count, not the data.
Tables of more than ``WIDE`` columns go through ``comoments``, with the same
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, is_numeric, numeric_columns
from ..session import save_table
from .comoments import wide_corr_matrix

#: Columns beyond which pairs are no longer aggregate expressions (see ``comoments``).
WIDE = 48


def _pair_r(a: str, b: str) -> Column:
    """r over the rows where both values are present."""
    both = c(a).isNotNull() & c(b).isNotNull()
    xa = F.when(both, c(a).cast("double"))
    xb = F.when(both, c(b).cast("double"))
    den = F.stddev_samp(xa) * F.stddev_samp(xb)
    return F.covar_samp(xa, xb) / F.nullif(den, F.lit(0.0))


def _all_pairs(df: DataFrame, names: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """One row with the r of every pair, as columns _0, _1, ...

    A first aggregate gives count, mean and range of each column.  Between two
    columns without missing values one sum per pair suffices, of products of
    values taken from the means; sums of squares are shared by all pairs.
    """
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[f(c(n)).alias(f"{k}{i}") for i, n in enumerate(names) for k, f in (
        ("c", F.count), ("m", lambda x: F.avg(x.cast("double"))), ("l", F.min), ("h", F.max))]).first()
    full = [stats[f"c{i}"] == stats["n"] and stats["n"] > 1 for i in range(len(names))]
    flat = [stats[f"l{i}"] == stats[f"h{i}"] for i in range(len(names))]
    x = [c(n).cast("double") - F.lit(float(stats[f"m{i}"] or 0.0)) for i, n in enumerate(names)]

    def r(i: int, j: int) -> Column:
        if flat[i] or flat[j]:
            return F.lit(None).cast("double")
        if not (full[i] and full[j]):
            return _pair_r(names[i], names[j])
        if i == j:
            return F.lit(1.0)
        return F.sum(x[i] * x[j]) / F.nullif(F.sqrt(F.sum(x[i] * x[i]) * F.sum(x[j] * x[j])), F.lit(0.0))

    return df.agg(F.count(F.lit(1)).alias("_n"), *[r(i, j).alias(f"_{k}") for k, (i, j) in enumerate(pairs)])


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long correlation matrix: (col_a, col_b, idx_a, idx_b, r) for every
    ordered pair, diagonal included (1.0, or NULL for a constant column)."""
    names = numeric_columns(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, idx_a int, idx_b int, r double")
    if len(names) > WIDE:
        return wide_corr_matrix(df, names)
    pairs = [(i, j) for j in range(len(names)) for i in range(j + 1)]
    cell = lambda i, j, k: F.struct(F.lit(names[i]).alias("col_a"), F.lit(names[j]).alias("col_b"), F.lit(i).alias("idx_a"), F.lit(j).alias("idx_b"), F.col(f"_{k}").alias("r"))
    cells = [x for k, (i, j) in enumerate(pairs) for x in ([cell(i, j, k)] if i == j else [cell(i, j, k), cell(j, i, k)])]
    return _all_pairs(df, names, pairs).select(F.explode(F.array(*cells)).alias("x")).select("x.*")


def corr_lower_triangle(matrix: DataFrame) -> DataFrame:
    """The cells a masked heat map shows: the upper triangle and the
    diagonal are masked, so only pairs with idx_a > idx_b remain."""
    return matrix.where(F.col("idx_a") > F.col("idx_b"))


def target_correlation(df: DataFrame, target_col: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, corr) of each numeric column with the target (target
    included, 1.0), ordered by corr descending."""
    if not is_numeric(df.schema[target_col].dataType):
        raise TypeError(f"target column {target_col!r} is not numeric")
    names = numeric_columns(df, columns)
    if target_col not in names:
        names = names + [target_col]
    row = df.agg(*[_pair_r(n, target_col).alias(f"_{i}") for i, n in enumerate(names)])
    long = row.unpivot([], [f"_{i}" for i in range(len(names))], "_k", "corr")
    return long.select(F.element_at(F.array(*[F.lit(n) for n in names]),
                                    F.substring("_k", 2, 10).cast("int") + 1).alias("feature"),
                       "corr").orderBy(F.col("corr").desc_nulls_last(), "feature")


def high_corr_pairs(df: DataFrame, threshold: float = 0.7, columns: Sequence[str] | None = None,
                    matrix: DataFrame | None = None) -> DataFrame:
    """Pairs above the diagonal with |r| > threshold (strict) as
    (feature_1, feature_2, abs_corr, idx_1, idx_2); NULL r never qualifies.
    Ordered by the second column's position, then the first's."""
    m = matrix if matrix is not None else corr_matrix(df, columns)
    return (m.where((F.col("idx_a") < F.col("idx_b")) & (F.abs("r") > F.lit(float(threshold))))
            .select(F.col("col_a").alias("feature_1"), F.col("col_b").alias("feature_2"),
                    F.abs("r").alias("abs_corr"), F.col("idx_a").alias("idx_1"),
                    F.col("idx_b").alias("idx_2"))
            .orderBy("idx_2", "idx_1"))


def features_to_drop(df: DataFrame, target_col: str, threshold: float = 0.7) -> DataFrame:
    """For each high pair drop the member with the lower |corr| to the
    target (ties and NULL drop the second); a feature is listed once, at its
    first drop.  Pairs whose member was dropped earlier still count, so this
    is set logic over the pair table, not a sequential loop.

    Returns (feature, drop_order).
    """
    if not is_numeric(df.schema[target_col].dataType):
        raise TypeError(f"target column {target_col!r} must be numeric")
    feats = [n for n in numeric_columns(df) if n != target_col]
    # one aggregate for the feature pairs and the target column together;
    # the d^2-row result is read twice, so it is written once (it is tiny)
    matrix = save_table(corr_matrix(df, feats + [target_col]), "correlations")
    fm = matrix.where(F.col("col_a").isin(feats) & F.col("col_b").isin(feats))
    pairs = high_corr_pairs(df, threshold, matrix=fm)
    # |corr| to the target, rounded to 12 decimals so that exact duplicates
    # (equal up to floating noise) count as a tie
    tc = matrix.where((F.col("col_b") == F.lit(target_col)) & (F.col("col_a") != F.lit(target_col))).select(
        F.col("col_a").alias("feature"), F.round(F.abs("r"), 12).alias("tc"))
    # tc has one row per feature (schema-bounded)
    t1 = F.broadcast(tc.select(F.col("feature").alias("feature_1"), F.col("tc").alias("tc1")))
    t2 = F.broadcast(tc.select(F.col("feature").alias("feature_2"), F.col("tc").alias("tc2")))
    scored = pairs.join(t1, "feature_1", "left").join(t2, "feature_2", "left")
    drop = F.when(F.col("tc1") < F.col("tc2"), F.col("feature_1")).otherwise(F.col("feature_2"))
    first = scored.select(drop.alias("feature"), F.struct("idx_2", "idx_1").alias("_pos")).groupBy(
        "feature").agg(F.min("_pos").alias("_pos"))
    from pyspark.sql import Window
    w = Window.orderBy(F.col("_pos"))  # one row per dropped feature
    return first.select("feature", F.row_number().over(w).alias("drop_order"))


def drop_highly_correlated_features(df: DataFrame, target_col: str,
                                    threshold: float = 0.7) -> tuple[DataFrame, list[str]]:
    """(df without the dropped features, dropped names in drop order)."""
    dropped = [r["feature"] for r in features_to_drop(df, target_col, threshold)
               .orderBy("drop_order").collect()]  # at most one row per column
    return df.drop(*dropped), dropped
