"""Exact quantiles by bracket: a sketch says where, a second scan counts.

``percentile`` ships every distinct value of a group to one task, and ranking
all values shuffles and sorts the whole column.  But an exact quantile needs
only the values next to its rank:

1. **Sketch.**  One aggregate keeps a mergeable quantile sketch per group
   (``percentile_approx``).  Around each wanted quantile it gives a narrow
   interval, the bracket, that holds the rank with a margin of three times the
   sketch's error: about 0.06 % of a group's values.  Groups of few values
   (``SMALL``) have all of them inside.
2. **Count.**  The next scan only counts the values between brackets (they
   collapse in the map tasks to one row per group and gap) and shuffles the
   distinct values inside, with their counts.
3. **Pick.**  Running counts over these give the exact ranks, and linear
   interpolation the quantile (``numpy.percentile``, SQL ``quantile_cont``).

A rank outside its bracket is seen (the row picked has no value); such groups
are ranked in full by running totals, so the result is exact whatever the
sketch says.  Brackets are one row per group: where that table exceeds
``BRACKET_BYTES`` the groups are so many that most are small, and all values
are ranked in full at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..session import save_table, table_bytes
from .cumulative import running_totals

PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.95)

ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY
SMALL = 2 * ACCURACY
#: Largest table of brackets (in bytes as written) that is broadcast.
BRACKET_BYTES = 32 << 20


def _pct_name(p: float) -> str:
    v = p * 100
    return f"p{int(v)}" if float(v).is_integer() else f"p{str(v).replace('.', '_')}"


def _safe_groups(df: DataFrame, gcols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rename group columns to plain internal names (dots and other odd
    characters never reach joins and window specs)."""
    safe = [f"_grp{i}" for i in range(len(gcols))]
    return df.select(*[c(g).alias(s) for g, s in zip(gcols, safe)],
                     *[c(n) for n in df.columns if n not in gcols]), safe


def _sketch(x: Column, probs: Sequence[float]) -> Column:
    asked = [min(max(p + side * MARGIN, 0.0), 1.0) for p in probs for side in (-1, 1)]
    return F.percentile_approx(x, asked, ACCURACY)


def _edges(n: Column, q: Column, probs: Sequence[float]) -> dict[str, Column]:
    """Bracket bounds from a count and a sketch: ``_lo<i>`` and ``_hi<i>``
    around the i-th smallest probability."""
    out = {}
    for i, p in enumerate(probs):
        low, high = F.lit(float("-inf")), F.lit(float("inf"))
        out[f"_lo{i}"] = low if p - MARGIN <= 0 else F.when(n <= SMALL, low).otherwise(q[2 * i])
        out[f"_hi{i}"] = high if p + MARGIN >= 1 else F.when(n <= SMALL, high).otherwise(q[2 * i + 1])
    return out


def brackets(vals: DataFrame, gcols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The brackets of each group of (groups..., _v)."""
    sketch = vals.groupBy(*gcols).agg(F.count(F.lit(1)).alias("_n"), _sketch(F.col("_v"), probs).alias("_q"))
    return sketch.select(*gcols, *[e.alias(k) for k, e in _edges(F.col("_n"), F.col("_q"), probs).items()])


def cells(vals: DataFrame, gcols: Sequence[str], bounds: DataFrame | dict, n_probs: int) -> DataFrame:
    """(groups..., _zone, _v, _w): values counted, with their value inside a
    bracket (odd zones) and without it in the gaps between (even zones)."""
    if isinstance(bounds, dict):
        joined, edge = vals, lambda name: F.lit(bounds[name])
    else:
        renamed = bounds.select(*[F.col(g).alias(f"_of{g}") for g in gcols], *[f"_{k}{i}" for i in range(n_probs) for k in ("lo", "hi")])
        same = F.lit(True)
        for g in gcols:
            same = same & F.col(g).eqNullSafe(F.col(f"_of{g}"))
        joined, edge = vals.join(F.broadcast(renamed), same), F.col
    return _counted(joined.select(*gcols, "_v", _zone(F.col("_v"), edge, n_probs).alias("_zone")), gcols)


def _zone(x: Column, edge, n_probs: int) -> Column:
    """Number of the gap (even) or bracket (odd) that holds ``x``."""
    zone = None
    for i in range(n_probs):
        below = x < edge(f"_lo{i}")
        zone = F.when(below, 2 * i) if zone is None else zone.when(below, 2 * i)
        zone = zone.when(x <= edge(f"_hi{i}"), 2 * i + 1)
    return zone.otherwise(2 * n_probs)


def _counted(placed: DataFrame, gcols: Sequence[str]) -> DataFrame:
    return (placed.select(*gcols, "_zone", F.when(F.col("_zone") % 2 == 1, F.col("_v")).alias("_v"))
            .groupBy(*gcols, "_zone", "_v").agg(F.count(F.lit(1)).alias("_w")))


def _position(n: Column, p: float) -> Column:
    return (n - 1).cast("double") * F.lit(float(p))


def _picked(ranked: DataFrame, gcols: Sequence[str], probs: Sequence[float], value: str, start: Column, width: Column, n: Column) -> DataFrame:
    """Per group: the values that hold the two ranks around each probability
    (``_lo<i>``, ``_hi<i>``), and the number of values."""
    aggs = [F.max(n).alias("_n")]
    for i, p in enumerate(probs):
        for name, rank in (("lo", F.floor(_position(n, p))), ("hi", F.ceil(_position(n, p)))):
            aggs.append(F.max(F.when((start <= rank) & (rank < start + width), c(value))).alias(f"_{name}{i}"))
    return ranked.groupBy(*gcols).agg(*aggs)


def _interpolated(picked: DataFrame, gcols: Sequence[str], orig: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    out = []
    for i, p in enumerate(probs):
        pos, lo, hi = _position(F.col("_n"), p), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (pos - F.floor(pos)) * (hi - lo)).alias(names[i]))
    return picked.select(*[F.col(g).alias(o) for g, o in zip(gcols, orig)], *out)


def percentiles_from_counts(base: DataFrame, value_col: str, weight_col: str,
                            probs: Sequence[float] = PERCENTILES, group_cols: Sequence[str] = (),
                            names: Sequence[str] | None = None) -> DataFrame:
    """Exact percentiles from a (group..., value, count) table with one row
    per distinct non-null value, by ranking all of them."""
    names = list(names or [_pct_name(p) for p in probs])
    base, gcols = _safe_groups(base, list(group_cols))
    return _interpolated(_ranked_in_full(base, gcols, value_col, weight_col, probs), gcols, list(group_cols), probs, names)


def _ranked_in_full(base: DataFrame, gcols: Sequence[str], value: str, weight: str, probs: Sequence[float]) -> DataFrame:
    ranked = running_totals(base, value, [weight], gcols)
    return _picked(ranked, gcols, probs, value, F.col(f"cum_{weight}") - c(weight), c(weight), F.col(f"tot_{weight}"))


def _picked_from_cells(counted: DataFrame, gcols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    # what is left of a group: a row per gap and the distinct values of its brackets
    upto = Window.partitionBy(*gcols).orderBy("_zone", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(*gcols, "_v", "_w", F.sum("_w").over(upto).alias("_cum"), F.sum("_w").over(Window.partitionBy(*gcols)).alias("_tot"))
    return _picked(ranked, gcols, probs, "_v", F.col("_cum") - F.col("_w"), F.col("_w"), F.col("_tot"))


def exact_percentiles(df: DataFrame, value_col: str, probs: Sequence[float] = PERCENTILES,
                      group_cols: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation, NULLs ignored; NULL groups
    are groups.  One row per group with a value; without group columns one row,
    of NULLs where there is no value."""
    orig, probs = list(group_cols), list(probs)
    names = list(names or [_pct_name(p) for p in probs])
    place = sorted(range(len(probs)), key=probs.__getitem__)
    rising = [probs[i] for i in place]
    keyed, gcols = _safe_groups(df.select(*[c(g) for g in orig], c(value_col).cast("double").alias("_v")), orig)
    vals = keyed.where(F.col("_v").isNotNull())
    if gcols:
        bounds = save_table(brackets(vals, gcols, rising), "brackets")
        if table_bytes(bounds) > BRACKET_BYTES:
            counts = vals.groupBy(*gcols, "_v").agg(F.count(F.lit(1)).alias("_w"))
            picked = _ranked_in_full(counts, gcols, "_v", "_w", rising)
            return _interpolated(picked, gcols, orig, rising, [names[i] for i in place]).select(*[c(o) for o in orig], *[c(n) for n in names])
    else:
        bounds = brackets(vals, gcols, rising).first().asDict()          # one row
    picked = save_table(_picked_from_cells(cells(vals, gcols, bounds, len(rising)), gcols, rising), "quantiles")
    picked = _exact(picked, vals, gcols, rising)
    return _interpolated(picked, gcols, orig, rising, [names[i] for i in place]).select(*[c(o) for o in orig], *[c(n) for n in names])


def _exact(picked: DataFrame, vals: DataFrame, gcols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The picks (a table that is there: saved, or a row per column), with the
    groups whose brackets missed a rank (the sketch was wrong, or the rank
    holds a NaN) ranked in full."""
    missed = F.lit(False)
    for i in range(len(probs)):
        missed = missed | F.col(f"_lo{i}").isNull() | F.col(f"_hi{i}").isNull()
    if picked.where(missed).isEmpty():
        return picked
    again = vals
    if gcols:
        own = picked.where(missed).select(*[F.col(g).alias(f"_of{g}") for g in gcols])
        same = F.lit(True)
        for g in gcols:
            same = same & F.col(g).eqNullSafe(F.col(f"_of{g}"))
        again = vals.join(own, same, "left_semi")
    counts = again.groupBy(*gcols, "_v").agg(F.count(F.lit(1)).alias("_w"))
    return picked.where(~missed).unionByName(_ranked_in_full(counts, gcols, "_v", "_w", probs))


def column_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact percentiles of many numeric columns at once: (column, names...),
    one row per column that has a value.  The sketches of all columns are one
    aggregate over the wide table (one row to the driver); the counting scan
    unpivots the cells with their zone."""
    place = sorted(range(len(probs)), key=probs.__getitem__)
    rising = [probs[i] for i in place]
    xs = [c(name).cast("double") for name in columns]
    row = df.agg(*[F.count(x).alias(f"n{k}") for k, x in enumerate(xs)], *[_sketch(x, rising).alias(f"q{k}") for k, x in enumerate(xs)])
    found = row.select(*[e.alias(f"{k}{name}") for k in range(len(xs)) for name, e in _edges(F.col(f"n{k}"), F.col(f"q{k}"), rising).items()]).first()
    cell = lambda k, x: F.struct(F.lit(k).alias("_grp0"), x.alias("_v"), _zone(x, lambda name: F.lit(found[f"{k}{name}"]), len(rising)).alias("_zone"))
    long = df.select(F.explode(F.array(*[cell(k, x) for k, x in enumerate(xs)])).alias("kv")).select("kv._grp0", "kv._v", "kv._zone").where(F.col("_v").isNotNull())
    picked = _picked_from_cells(_counted(long, ["_grp0"]), ["_grp0"], rising)
    picked = df.sparkSession.createDataFrame(picked.collect(), picked.schema)        # a row per column
    picked = _exact(picked, long, ["_grp0"], rising)
    label = F.array(*[F.lit(name) for name in columns])
    out = _interpolated(picked, ["_grp0"], ["_k"], rising, [names[i] for i in place])
    return out.select(label[F.col("_k")].alias("column"), *[c(n) for n in names])
