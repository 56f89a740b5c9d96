"""``anova_for_column``: every group analysis of one numeric column.

The per-group figures (statistics, coefficient of variation, range,
percentiles, box-plot whiskers) come back as one wide table, one row per
group; the across-group figures (ANOVA, variance decomposition) as one-row
tables; the histogram as its long table.  Group statistics are computed
once and reused by the coefficient of variation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, long_form
from ..operators import groups, hist, outliers


@dataclass(frozen=True)
class ColumnAnalysis:
    per_group: DataFrame      # stats, cv, range, percentiles, whiskers
    anova: DataFrame          # one row
    variance: DataFrame       # one row
    histogram: DataFrame      # (group, bin, bin_start, bin_end, count)


def group_profile(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """One row per group: count, sum, mean, std, var, min, max, median,
    cv, range, p25..p95 (statistics rounded to 2 as in ``group_stats``)."""
    stats = groups.coefficient_of_variation(groups.group_stats(df, group_col, value_col))
    rng = groups.group_range(df, group_col, value_col).select(c(group_col), "range")
    pct = groups.group_percentiles(df, group_col, value_col)
    # all three tables have one row per group
    return stats.join(rng, group_col, "left").join(pct, group_col, "left")


def anova_for_column(df: DataFrame, group_col: str, value_col: str, bins: int = 30) -> ColumnAnalysis:
    return ColumnAnalysis(
        per_group=group_profile(df, group_col, value_col).join(
            outliers.boxplot_stats(df, group_col, value_col).select(
                c(group_col), "whisker_low", "whisker_high", "n_fliers"), group_col, "left"),
        anova=groups.anova_oneway(df, group_col, value_col),
        variance=groups.variance_decomposition(df, group_col, value_col),
        histogram=hist.group_histogram(df, group_col, value_col, bins))


def all_results(found: ColumnAnalysis, group_col: str) -> DataFrame:
    """Every result as (result, label, at, metric, value): ``label`` is the
    group, ``at`` the bin of the histogram."""
    rest = lambda df, *skip: [n for n in df.columns if n not in skip]
    per, hist_ = found.per_group, found.histogram
    return (long_form(per, "per_group", rest(per, group_col), c(group_col))
            .unionByName(long_form(found.anova, "anova", rest(found.anova)))
            .unionByName(long_form(found.variance, "variance", rest(found.variance)))
            .unionByName(long_form(hist_, "histogram", rest(hist_, group_col, "bin"), c(group_col), F.col("bin"))))
