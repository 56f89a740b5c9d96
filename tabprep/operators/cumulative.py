"""Running totals over an ordered key, without a single-task window.

A plain ``sum().over(Window.orderBy(k))`` moves every row into one task, and
``Window.partitionBy(g)`` does the same for each group, so a group holding a
third of the table becomes a third of the table in one task.  Here a prefix
scan in two phases does it over **one** exchange of the rows:

1. One aggregate sketches the order key: range bounds that hold about
   ``rows_per_bucket`` rows each.  A row's range is a function of its key
   alone (binary search in the bounds), so a row gets the same range wherever
   and however often it is computed; a range stays whole when a task is
   repeated on another executor.
2. Sums per (group, range) come from a partial aggregate, and their running
   sums are the offsets: a table of one row per range and group in it.
3. Each offset joins its range as a first row, not by a join: the union is
   dealt by (group, range), and the running sum inside a range starts at the
   offset.

Nothing is written.  The result is identical to the plain window when the
order key is unique within a group; NULL groups are groups like others, and
sums keep their column's type.  A table of one range needs no offsets.  The
number of ranges is bounded (``RANGES``); beyond that ranges grow and sort with
spilling.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, is_numeric, is_string

ROWS_PER_BUCKET = 100_000
#: Numbers of ranges a sketch is made for: the first that suffices is used, the last bounds them.
RANGES = (128, 4096)


def _order(col: str, descending: bool) -> Column:
    return c(col).desc() if descending else c(col).asc()


def order_number(df: DataFrame, name: str) -> Column:
    """A double that never falls where the column rises: numbers and times as
    they are, text and bytes by their first six bytes."""
    kind, col = df.schema[name].dataType, c(name)
    if is_numeric(kind):
        return col.cast("double")
    if isinstance(kind, T.BooleanType):
        return col.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.datediff(col, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp").cast("double")
    if is_string(kind) or isinstance(kind, T.BinaryType):
        return F.conv(F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise ValueError(f"cannot order ranges by a column of type {kind.simpleString()}")


def range_bounds(df: DataFrame, name: str, rows_per_bucket: int) -> list[float]:
    """Ascending bounds between ranges of about ``rows_per_bucket`` rows: one
    aggregate with a mergeable sketch, a second one where the table needs more
    ranges than the first is made for; at most ``RANGES[-1]`` numbers."""
    number = F.when(~F.isnan(order_number(df, name)), order_number(df, name))
    for most in RANGES:
        shares = [k / most for k in range(1, most)]
        row = df.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(number, shares, 4 * most).alias("q")).first()
        ranges = -(-row["n"] // rows_per_bucket)
        if ranges <= most:
            break
    ranges = min(ranges, most)
    if ranges <= 1 or not row["q"]:
        return []
    return sorted(v for v in {row["q"][k * most // ranges - 1] for k in range(1, ranges)} if math.isfinite(v))


def with_range(df: DataFrame, name: str, bounds: list[float], made: str = "_b") -> DataFrame:
    """Add the number of the row's range: how many bounds are not above its
    key; NULL keys come before all others (-1) and NaN after them."""
    found = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_number", outputCol="_range", handleInvalid="keep")
    out = found.transform(df.withColumn("_number", order_number(df, name)))
    return out.withColumn(made, F.when(F.col("_number").isNull(), F.lit(-1)).otherwise(F.col("_range").cast("int"))).drop("_number", "_range")


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), descending: bool = False,
                   rows_per_bucket: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in key order within the
    partition) and ``tot_<c>`` (partition total) for each ``c`` in
    ``sum_cols``.  ``order_col`` must be unique within a partition (callers
    aggregate by it first)."""
    part, sums, names = list(partition_cols), list(sum_cols), df.columns
    bounds, keys = range_bounds(df, order_col, rows_per_bucket or ROWS_PER_BUCKET), [c(p) for p in part]
    if not bounds:
        upto = Window.partitionBy(*keys).orderBy(_order(order_col, descending)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[F.sum(c(s)).over(upto).alias(f"cum_{s}") for s in sums],
                         *[F.sum(c(s)).over(Window.partitionBy(*keys)).alias(f"tot_{s}") for s in sums])
    dealt = with_range(df, order_col, bounds)
    per = dealt.groupBy(*[c(p) for p in part], "_b").agg(*[F.sum(c(s)).alias(f"_s{i}") for i, s in enumerate(sums)])
    earlier = Window.partitionBy(*keys).orderBy(_order("_b", descending)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    kinds = {f"_s{i}": per.schema[f"_s{i}"].dataType for i in range(len(sums))}
    offsets = per.select(*keys, "_b", F.lit(0).alias("_row"),
                         *[F.coalesce(F.sum(f"_s{i}").over(earlier), F.lit(0)).cast(kinds[f"_s{i}"]).alias(f"_s{i}") for i in range(len(sums))],
                         *[F.sum(f"_s{i}").over(whole).cast(kinds[f"_s{i}"]).alias(f"_tot{i}") for i in range(len(sums))])
    rows = dealt.select(*[c(n) for n in names], "_b", F.lit(1).alias("_row"),
                        *[c(s).cast(kinds[f"_s{i}"]).alias(f"_s{i}") for i, s in enumerate(sums)])
    both = rows.unionByName(offsets, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_b").orderBy("_row", _order(order_col, descending)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.select(*[c(n) for n in names], "_row",
                      *[F.sum(f"_s{i}").over(inside).cast(kinds[f"_s{i}"]).alias(f"cum_{s}") for i, s in enumerate(sums)],
                      *[F.first(f"_tot{i}").over(inside).alias(f"tot_{s}") for i, s in enumerate(sums)])
    return out.where("_row = 1").drop("_row")
