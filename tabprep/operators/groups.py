"""Group statistics, one-way ANOVA, percentiles, variance decomposition.

Every operator is one ``groupBy().agg()`` (partial aggregation before the
shuffle, so a hot group costs one row per map task), plus a second tiny
aggregate over the per-group table where a statistic spans groups.  Exact
percentiles never hold a group in one task: see ``quantiles``.

Shared rules: NULL group keys are dropped (pandas ``groupby`` does), ``count``
counts non-null values, std/var are the sample (ddof 1) versions and are NULL
for a one-row group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.distributions import f_sf_udf
from ..functions.numeric import safe_div
from ..session import save_table
from .quantiles import PERCENTILES, _pct_name, _safe_groups, exact_percentiles

_AGGS = {
    "count": lambda x: F.count(x),
    "sum": lambda x: F.coalesce(F.sum(x), F.lit(0)),  # a group without values sums to 0
    "mean": lambda x: F.avg(x),
    "std": lambda x: F.stddev_samp(x),
    "var": lambda x: F.var_samp(x),
    "min": lambda x: F.min(x),
    "max": lambda x: F.max(x),
    "median": None,  # exact, through exact_percentiles (see group_agg_multi)
    "nunique": lambda x: F.count_distinct(x),
}


def _keyed(df: DataFrame, group_col: str) -> DataFrame:
    return df.where(c(group_col).isNotNull())


def group_percentiles(df: DataFrame, group_col: str, value_col: str,
                      probs: Sequence[float] = PERCENTILES, exact: bool = True,
                      accuracy: int = 10_000) -> DataFrame:
    """25/50/75/90/95th percentile per group.  ``exact=False`` uses the
    ``percentile_approx`` sketch (one pass, bounded memory per group)."""
    keyed = _keyed(df, group_col)
    if exact:
        return exact_percentiles(keyed, value_col, probs, [group_col])
    arr = F.percentile_approx(c(value_col).cast("double"), list(probs), accuracy)
    return (keyed.groupBy(c(group_col)).agg(arr.alias("_q"))
            .select(c(group_col), *[F.col("_q")[i].alias(_pct_name(p)) for i, p in enumerate(probs)]))


def group_mean_count_sum(df: DataFrame, group_col: str, agg_col: str,
                         total: str = "sum") -> DataFrame:
    """mean, count and sum per group plus a ``Total`` row.

    ``total="sum"`` (default) makes Total the column sum of the group rows,
    so its mean is the sum of the group means; ``total="rollup"`` gives true
    overall figures instead.
    """
    x = c(agg_col)
    keyed = _keyed(df, group_col)
    if total == "rollup":
        # true overall figures: one rollup pass over the data
        r = keyed.rollup(c(group_col).cast("string").alias("_g")).agg(
            F.grouping_id().alias("_gid"), F.avg(x).alias("mean"), F.count(x).alias("count"),
            F.coalesce(F.sum(x), F.lit(0)).cast("double").alias("sum"))
    elif total == "sum":
        per = keyed.groupBy(c(group_col).cast("string").alias("_g")).agg(
            F.avg(x).alias("m"), F.count(x).alias("n"), F.coalesce(F.sum(x), F.lit(0)).cast("double").alias("s"))
        # rollup over the small per-group table: each group row, plus a Total
        # row that is the column sum of the group rows (sum of means included)
        r = per.rollup("_g").agg(F.grouping_id().alias("_gid"), F.sum("m").alias("mean"),
                                 F.sum("n").alias("count"), F.sum("s").alias("sum"))
    else:
        raise ValueError("total must be 'sum' or 'rollup'")
    label = F.when(F.col("_gid") == 1, F.lit("Total")).otherwise(F.col("_g")).alias(group_col)
    return r.select(label, "mean", F.col("count").cast("long").alias("count"), "sum")


def group_agg_multi(df: DataFrame, group_col: str, agg_cols: Mapping[str, Sequence[str]],
                    sort_by: tuple[str, str] | None = None, decimals: int = 2,
                    total: bool = True) -> DataFrame:
    """Any ``{column: [aggregates]}`` per group, rounded, columns named
    ``{column}_{aggregate}``, optional descending sort, then a ``Total`` row
    holding the sums of the rounded group rows."""
    aggs, names, medians = [], [], []
    for col, funcs in agg_cols.items():
        for fn in funcs:
            if fn not in _AGGS:
                raise ValueError(f"unknown aggregate {fn!r}; choose from {sorted(_AGGS)}")
            name = f"{col}_{fn}"
            names.append(name)
            if fn == "median":
                medians.append((col, name))
            else:
                aggs.append(F.round(_AGGS[fn](c(col)).cast("double"), decimals).alias(name))
    keyed = _keyed(df, group_col).withColumn("__key", c(group_col).cast("string"))
    out = keyed.groupBy("__key").agg(*aggs) if aggs else keyed.select("__key").distinct()
    for col, name in medians:
        med = exact_percentiles(keyed, col, [0.5], ["__key"], ["__m"])
        out = out.join(med.select("__key", F.round("__m", decimals).alias(name)), "__key", "left")
    if total:
        # Total = sum of the rounded group rows: rollup over the small table
        out = out.rollup("__key").agg(F.grouping_id().alias("_gid"),
                                      *[F.round(F.sum(c(n)), decimals).alias(n) for n in names])
        out = out.select(F.when(F.col("_gid") == 1, F.lit("Total")).otherwise(F.col("__key"))
                         .alias(group_col), *[c(n) for n in names])
    else:
        out = out.select(F.col("__key").alias(group_col), *[c(n) for n in names])
    if sort_by is not None:
        key = f"{sort_by[0]}_{sort_by[1]}"
        if key not in names:
            raise ValueError(f"sort key {sort_by!r} is not one of the aggregates")
        out = out.orderBy(c(key).desc_nulls_last())
    return out


def group_stats(df: DataFrame, group_col: str, value_col: str, decimals: int = 2,
                exact_median: bool = True) -> DataFrame:
    """count, sum, mean, std, var, min, max, median per group, rounded."""
    keyed, (g,) = _safe_groups(_keyed(df, group_col).select(c(group_col), c(value_col)), [group_col])
    x = c(value_col).cast("double")
    stats = keyed.groupBy(g).agg(
        F.count(x).alias("count"), F.coalesce(F.sum(x), F.lit(0.0)).alias("sum"),
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.var_samp(x).alias("var"),
        F.min(x).alias("min"), F.max(x).alias("max"))
    if exact_median:
        med = exact_percentiles(keyed, value_col, [0.5], [g], ["median"])
    else:
        med = keyed.groupBy(g).agg(F.percentile_approx(x, 0.5, 10_000).alias("median"))
    # one row per group on both sides; groups without values get a NULL median
    joined = stats.join(med, g, "left")
    cols = ["sum", "mean", "std", "var", "min", "max", "median"]
    return joined.select(F.col(g).alias(group_col), "count", *[F.round(c(k), decimals).alias(k) for k in cols])


def coefficient_of_variation(stats: DataFrame) -> DataFrame:
    """``std / mean * 100`` from the (already rounded) ``group_stats``."""
    return stats.withColumn("cv", safe_div(F.col("std"), F.col("mean")) * F.lit(100.0))


def anova_oneway(df: DataFrame, group_col: str, value_col: str, alpha: float = 0.05) -> DataFrame:
    """One-way ANOVA across all groups: one row with the F statistic, its
    degrees of freedom, the p-value and ``significant = p < alpha``.

    One ``rollup`` pass gives count, mean and variance of every group and of
    all rows; that table (one row per group) is written once and read for the
    grand mean M and for SSB = sum n_g (m_g - M)^2, SSW = sum (n_g - 1) v_g.
    """
    x = c(value_col).cast("double")
    r = (_keyed(df, group_col).where(x.isNotNull()).rollup(c(group_col).alias("_g"))
         .agg(F.grouping_id().alias("_gid"), F.count(x).alias("n"), F.avg(x).alias("m"), F.var_samp(x).alias("v")))
    r = save_table(r, "anova")
    grand = r.where("_gid = 1").select("m").first()
    mean = F.lit(float(grand["m"]) if grand and grand["m"] is not None else 0.0)
    sums = r.where("_gid = 0").agg(F.sum("n").alias("n_total"), F.count(F.lit(1)).alias("n_groups"),
                                   F.sum(F.col("n") * (F.col("m") - mean) ** 2).alias("ss_between"),
                                   F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ss_within"))
    d1 = (F.col("n_groups") - 1).cast("double")
    d2 = (F.col("n_total") - F.col("n_groups")).cast("double")
    f_stat = safe_div(safe_div(F.col("ss_between"), d1), safe_div(F.col("ss_within"), d2))
    out = sums.select("n_groups", "n_total", "ss_between", "ss_within",
                      d1.alias("df_between"), d2.alias("df_within"), f_stat.alias("f_stat"))
    out = out.withColumn("p_value", f_sf_udf(F.col("f_stat"), F.col("df_between"), F.col("df_within")))
    return out.withColumn("significant", F.col("p_value") < F.lit(alpha))


def group_range(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    x = c(value_col)
    return (_keyed(df, group_col).groupBy(c(group_col))
            .agg(F.min(x).alias("min"), F.max(x).alias("max"))
            .withColumn("range", F.col("max") - F.col("min")))


def group_std(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    return _keyed(df, group_col).groupBy(c(group_col)).agg(
        F.stddev_samp(c(value_col).cast("double")).alias("std"))


def variance_decomposition(df: DataFrame, group_col: str, value_col: str,
                           df_groups: int | None = None) -> DataFrame:
    """Total, within- and between-group variance and their ratio.

    total = sample variance of the column over **all** rows; within =
    sum (n_g - 1) var_g / (N - k) over the groups (NULL key dropped), with
    n_g counting rows (NULL values included) as ``len(group)`` does;
    ``df_groups`` overrides k (pass 3 to reproduce the reference's fixed
    constant).  One ``rollup`` pass yields the per-group rows and the grand
    row together; a tiny aggregate over those rows finishes the job.
    """
    x = c(value_col).cast("double")
    r = df.rollup(c(group_col).alias("_g")).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("rows"), F.var_samp(x).alias("v"))
    grp = (F.col("_gid") == 0) & F.col("_g").isNotNull()
    k = F.lit(df_groups) if df_groups is not None else F.count_if(grp)
    out = r.agg(
        F.max(F.when(F.col("_gid") == 1, F.col("v"))).alias("total_var"),
        safe_div(F.sum(F.when(grp, F.coalesce((F.col("rows") - 1) * F.col("v"), F.lit(0.0)))),
                 F.sum(F.when(grp, F.col("rows"))) - k).alias("within_var"))
    return (out.withColumn("between_var", F.col("total_var") - F.col("within_var"))
            .withColumn("ratio", safe_div(F.col("between_var"), F.col("within_var"))))
