"""The tables behind the histogram, violin and class-distribution plots.

Histograms use equal-width bins over each group's own [min, max] (the last
bin closed), like ``numpy.histogram``; a group whose values are all equal
gets the range [v - 0.5, v + 0.5].  Min/max per group come from one
aggregate, the per-group table is joined back, and bins are counted with a
second aggregate; empty bins are filled from a (groups x bins) grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..session import save_table, table_bytes
from .outliers import _numeric_long

BINS = 30
#: Largest table of one row per group (in bytes as written) that is broadcast to the rows.
TABLE_BYTES = 32 << 20
DEFAULT_FEATURES = ("fico", "int.rate", "dti", "revol.util", "inq.last.6mths", "delinq.2yrs")


def histogram(df: DataFrame, value_col: str, group_cols: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """(groups..., bin, bin_start, bin_end, count) with all ``bins`` bins."""
    g = list(group_cols)
    if not g:
        raise ValueError("histogram needs at least one group column (each group gets its own range)")
    x = c(value_col).cast("double")
    vals = df.select(*[c(k) for k in g], x.alias("_x")).where(F.col("_x").isNotNull())
    for k in g:
        vals = vals.where(c(k).isNotNull())
    rng = vals.groupBy(*g).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    lo = F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - F.lit(0.5))
    hi = F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + F.lit(0.5))
    rng = rng.select(*g, lo.alias("_lo"), ((hi - lo) / F.lit(float(bins))).alias("_w"))
    # one row per group: broadcast if its bytes allow, so that rows of a hot
    # group stay where they are; else a shuffle join, split where it is skewed
    rng = save_table(rng, "ranges")
    rng = F.broadcast(rng) if table_bytes(rng) <= TABLE_BYTES else rng
    idx = F.least(F.lit(bins - 1), F.floor((F.col("_x") - F.col("_lo")) / F.col("_w")).cast("int"))
    counts = vals.join(rng, g).groupBy(*g, idx.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_w").alias("_w"))
    # empty bins: per group at most `bins` (bin, count) pairs are gathered
    # and every bin is emitted from them -- no second pass over the data
    per = counts.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("_m"),
                                 F.first("_lo").alias("_lo"), F.first("_w").alias("_w"))
    out = per.select(*g, "_lo", "_w", "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return out.select(*g, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
                      F.coalesce(F.col("_m")[F.col("bin")], F.lit(0)).cast("long").alias("count"))


def group_histogram(df: DataFrame, group_col: str, value_col: str, bins: int = BINS) -> DataFrame:
    return histogram(df, value_col, [group_col], bins)


def class_histogram(df: DataFrame, target_col: str, features: Sequence[str] | None = None,
                    bins: int = BINS) -> DataFrame:
    """Per feature and class: 30 bins over that class's own range.
    (feature, class, bin, bin_start, bin_end, count)."""
    names = [f for f in (features or DEFAULT_FEATURES) if f in df.columns]
    long = _numeric_long(df, names, [target_col]).withColumnRenamed("column", "feature")
    out = histogram(long, "value", ["feature", target_col], bins)
    return out.withColumnRenamed(target_col, "class")


def _density_groups(df: DataFrame, group_col: str, value_col: str) -> tuple[DataFrame, DataFrame]:
    """Values of each group, and per group count, range and Scott bandwidth."""
    x = c(value_col).cast("double")
    vals = df.select(c(group_col), x.alias("_x")).where(c(group_col).isNotNull() & F.col("_x").isNotNull())
    st = vals.groupBy(c(group_col)).agg(
        F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
        F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    return vals, st.select(c(group_col), "_n", "_mn", "_mx",
                           (F.coalesce(F.nullif(F.col("_sd"), F.lit(0.0)), F.lit(1.0))
                            * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_h"))


def _kernel(x: Column, at: Column) -> Column:
    z = (x - at) / F.col("_h")
    return F.exp(F.lit(-0.5) * z * z) / (F.col("_h") * F.col("_n") * F.lit((2 * 3.141592653589793) ** 0.5))


def group_density(df: DataFrame, group_col: str, value_col: str, grid_points: int = 64, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density per group on ``grid_points`` evenly spaced
    points over the group's range, Scott bandwidth h = std * n^(-1/5).

    Without ``bins`` every row contributes to every grid point of its group
    (rows x grid_points terms, as partial sums).  With ``bins`` each row is
    counted once, by linear binning: it is shared between the two ends of its
    bin in proportion to its distance from them, and the kernel is summed over
    the bins.  For bins of width w the density differs from the direct sum by
    at most (w / h)^2 / 8 / (h * sqrt(2 pi)); the work is one aggregate over
    the rows and bins x grid_points terms per group, whatever the rows.
    """
    vals, st = _density_groups(df, group_col, value_col)
    pts = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("point")
    step = (F.col("_mx") - F.col("_mn")) / F.lit(float(max(grid_points - 1, 1)))
    at = F.col("_mn") + F.col("point") * F.col("_s")
    if bins is None:
        joined = vals.join(st, group_col).select(c(group_col), "_x", "_n", "_h", "_mn", step.alias("_s"), pts)
        return joined.groupBy(c(group_col), "point").agg(F.first(at).alias("x"), F.sum(_kernel(F.col("_x"), at)).alias("density"))
    if bins < 2:
        raise ValueError("bins must be at least 2")
    st = save_table(st, "density")
    width = F.when(F.col("_mx") > F.col("_mn"), (F.col("_mx") - F.col("_mn")) / F.lit(float(bins - 1))).otherwise(F.lit(1.0))
    own = st.select(c(group_col).alias("_g"), F.col("_mn").alias("_from"), width.alias("_w"))
    own = F.broadcast(own) if table_bytes(st) <= TABLE_BYTES else own       # a row per group
    place = (F.col("_x") - F.col("_from")) / F.col("_w")
    low = F.least(F.floor(place).cast("int"), F.lit(bins - 2))
    shared = vals.join(own, c(group_col) == F.col("_g")).select("_g", low.alias("_b"), (place - low).alias("_part"))
    counted = shared.groupBy("_g", "_b").agg(F.sum(1 - F.col("_part")).alias("_here"), F.sum("_part").alias("_next"))
    ends = F.explode(F.array(F.struct(F.col("_b").alias("b"), F.col("_here").alias("w")), F.struct((F.col("_b") + 1).alias("b"), F.col("_next").alias("w")))).alias("e")
    grid = counted.select("_g", ends).groupBy("_g", F.col("e.b").alias("_b")).agg(F.sum("e.w").alias("_share"))
    groups = st.select(c(group_col).alias("_g"), "_n", "_h", "_mn", step.alias("_s"), width.alias("_w"))
    met = grid.join(groups, "_g").select("_g", "_n", "_h", "_mn", "_s", (F.col("_mn") + F.col("_b") * F.col("_w")).alias("_x"), "_share", pts)
    return met.groupBy(F.col("_g").alias(group_col), "point").agg(F.first(at).alias("x"), F.sum(F.col("_share") * _kernel(F.col("_x"), at)).alias("density"))


def category_by_target(df: DataFrame, category_col: str, target_col: str) -> DataFrame:
    """Counts per (category, target) plus the category's total, for the
    countplot ordered by category frequency."""
    keyed = df.where(c(category_col).isNotNull() & c(target_col).isNotNull())
    per = keyed.groupBy(c(category_col), c(target_col)).agg(F.count(F.lit(1)).alias("count"))
    # one row per (category, class): the category total is a window over it
    return per.withColumn("category_total", F.sum("count").over(Window.partitionBy(c(category_col))))
