"""Exact, reproducible stratified train / validation / test split.

Sizes follow the usual rule: ``n_test = ceil(test_size * n)``, then
``n_val = ceil(val_size * (n - n_test))``; each class gets its share by the
largest-remainder rule (integer arithmetic, ties to the smaller class
value), so class proportions are kept and totals are exact.

Which rows go where: rows of a class are ordered by ``md5(key || ':' ||
seed)`` and the first ``test`` rows go to test, the next ``val`` rows to
validation.  The order is a pure function of the key, so the split is
reproducible and survives recomputation after an executor loss.

At scale a per-class window would put a whole class in one task.  Instead
the md5 prefix cuts each class into 65,536 ordered buckets; bucket counts
(classes x 65,536 rows) give each bucket its starting rank, whole buckets
are assigned directly, and only the at most two buckets per class that
straddle a boundary are ranked row by row.

Quotas of up to ``DRIVER_CLASSES`` classes are worked out on the driver; with
more they stay a table.  Classes of one size share a remainder, so the
remainders form a short table whose running totals say which of them get one
more row; only the remainder at the cut is settled class by class, in class
order.  Both give the same quotas.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..session import save_table
from .cumulative import running_totals

#: Classes whose counts and quotas are handled on the driver.
DRIVER_CLASSES = 1000
_BUCKET_HEX = 4  # 16 bits of the md5 prefix -> 65,536 buckets per class
_ALL = "__all__"
_BROADCAST_CLASSES = 16  # times 65,536 buckets: about a million short rows


def order_key(key_col: str, seed: int, row: Sequence[str] = ()) -> Column:
    """md5 of the key and the seed.  A row with a NULL key is placed by a hash
    of its other columns, so it takes part in the split like any row."""
    key = F.coalesce(c(key_col).cast("string"), F.concat(F.lit("null:"), F.xxhash64(*[c(n) for n in row]).cast("string")) if row else F.lit("null:"))
    return F.md5(F.concat(key, F.lit(f":{seed}")))


def largest_remainder(counts: Mapping, total: int) -> dict:
    """Share ``total`` among classes proportionally to ``counts`` exactly."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    base = {k: (total * v) // n for k, v in counts.items()}
    rem = {k: (total * v) % n for k, v in counts.items()}
    left = total - sum(base.values())
    for k in sorted(counts, key=lambda k: (-rem[k], k))[:left]:
        base[k] += 1
    return base


def split_quotas(counts: Mapping, test_size: float, val_size: float) -> dict:
    """{class: (n_test, n_val)}"""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    test = largest_remainder(counts, n_test)
    rest = {k: counts[k] - test[k] for k in counts}
    n_val = math.ceil(val_size * (n - n_test)) if val_size > 0 else 0
    val = largest_remainder(rest, n_val) if n_val else {k: 0 for k in counts}
    return {k: (test[k], val[k]) for k in counts}


def _shared_out(counts: DataFrame, size: str, total: int, out: str) -> DataFrame:
    """``largest_remainder`` on a table: shares ``total`` among the classes
    ``_cls`` in proportion to ``size`` (at most the table's sum)."""
    n = int(counts.agg(F.sum(size)).first()[0] or 0)
    if not n or not total:
        return counts.withColumn(out, F.lit(0).cast("bigint"))
    whole = F.col(size).cast("decimal(38,0)") * F.lit(total).cast("decimal(19,0)")
    based = counts.withColumn("_base", F.floor(whole / F.lit(n).cast("decimal(19,0)")).cast("bigint"))
    based = save_table(based.withColumn("_rem", (whole - F.col("_base").cast("decimal(19,0)") * F.lit(n).cast("decimal(19,0)")).cast("bigint")), "quotas")
    left = total - int(based.agg(F.sum("_base")).first()[0])
    # remainders from the largest down, with how many classes have them
    ranked = running_totals(based.groupBy("_rem").agg(F.count(F.lit(1)).alias("_many")), "_rem", ["_many"], descending=True)
    cut = ranked.where((F.col("cum__many") - F.col("_many") < left) & (F.col("cum__many") >= left)).select(
        "_rem", (F.lit(left) - F.col("cum__many") + F.col("_many")).alias("_take")).first()
    if cut is None:                                   # nothing is left to share out
        return based.select(*counts.columns, F.col("_base").alias(out))
    at_cut = based.where(F.col("_rem") == cut["_rem"]).withColumn("_one", F.lit(1))
    at_cut = running_totals(at_cut, "_cls", ["_one"]).select(
        *counts.columns, (F.col("_base") + (F.col("cum__one") <= cut["_take"]).cast("int")).cast("bigint").alias(out))
    rest = based.where(F.col("_rem") != cut["_rem"]).select(
        *counts.columns, (F.col("_base") + (F.col("_rem") > cut["_rem"]).cast("int")).cast("bigint").alias(out))
    return rest.unionByName(at_cut)


def quota_table(counts: DataFrame, test_size: float, val_size: float) -> DataFrame:
    """(_cls, _cuts): ``split_quotas`` on a table of (_cls, _n); cuts are the
    running sums of a class' test and validation rows."""
    n = int(counts.agg(F.sum("_n")).first()[0] or 0)
    n_test = math.ceil(test_size * n)
    test = save_table(_shared_out(counts, "_n", n_test, "_test").withColumn("_rest", F.col("_n") - F.col("_test")), "quotas")
    n_val = math.ceil(val_size * (n - n_test)) if val_size > 0 else 0
    both = _shared_out(test, "_rest", n_val, "_val")
    return save_table(both.select("_cls", F.array("_test", F.col("_test") + F.col("_val")).alias("_cuts")), "quotas")


def quota_assign(df: DataFrame, key_col: str, cls: Column, quotas: Mapping | DataFrame, names: Sequence[str],
                 rest: str, seed: int, out_col: str) -> DataFrame:
    """Label rows by their rank in md5 order within their class: the first
    ``quotas[cls][0]`` rows get ``names[0]``, the next ``quotas[cls][1]``
    get ``names[1]``, ...; the remaining rows get ``rest``.  Whole md5-prefix
    buckets are labelled directly; only buckets straddling a cut are ranked
    row by row.  ``quotas``: a mapping, or a (_cls, _cuts) table of running
    sums."""
    h = order_key(key_col, seed, [n for n in df.columns if n != key_col])
    tagged = df.select("*", cls.alias("_cls"), h.alias("_h"),
                       F.conv(F.substring(h, 1, _BUCKET_HEX), 16, 10).cast("int").alias("_bk"))
    per_bucket = tagged.groupBy("_cls", "_bk").agg(F.count(F.lit(1)).alias("_n"))
    # starting rank of each bucket; the window spans <= 65,536 rows per class
    w = Window.partitionBy("_cls").orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select("_cls", "_bk", "_n",
                               F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    if isinstance(quotas, DataFrame):
        cuts, few = F.col("_of"), False
        starts = starts.join(quotas.select("_cls", F.col("_cuts").alias("_of")), "_cls")
    else:
        cuts_of = {k: [sum(q[:i + 1]) for i in range(len(q))] for k, q in quotas.items()}
        few = len(quotas) <= _BROADCAST_CLASSES
        cuts = F.create_map(*[x for k, cs in cuts_of.items() for x in (F.lit(k), F.array(*[F.lit(int(v)) for v in cs]))])[F.col("_cls")]
    end = F.col("_start") + F.col("_n")
    straddles = F.exists(cuts, lambda x: (F.col("_start") < x) & (end > x))
    starts = starts.select("_cls", "_bk", "_start", F.coalesce(straddles, F.lit(False)).alias("_edge"),
                           cuts.alias("_cuts"))
    # one row per class and bucket: broadcast for few classes, else a shuffle join
    joined = tagged.join(F.broadcast(starts) if few else starts, ["_cls", "_bk"])

    def label(rank: Column) -> Column:
        out = F.lit(rest)
        for i in reversed(range(len(names))):
            out = F.when(rank < F.col("_cuts")[i], F.lit(names[i])).otherwise(out)
        return out

    whole = joined.where(~F.col("_edge")).withColumn(out_col, label(F.col("_start")))
    ranked = Window.partitionBy("_cls", "_bk").orderBy("_h")
    edge = joined.where(F.col("_edge")).withColumn(
        out_col, label(F.col("_start") + F.row_number().over(ranked) - 1))
    return whole.unionByName(edge).drop("_cls", "_h", "_bk", "_start", "_edge", "_cuts")


def class_totals(df: DataFrame, cls: Column) -> dict:
    """{class: rows}; one row per class reaches the driver."""
    return {r["k"]: r["n"] for r in df.groupBy(cls.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}


def stratified_split(df: DataFrame, key_col: str, label_col: str | None, test_size: float = 0.3,
                     val_size: float = 0.2, seed: int = 42, split_col: str = "split") -> DataFrame:
    """Add ``split`` in {'train', 'val', 'test'}.  ``label_col=None`` splits
    without class quotas (one pseudo-class)."""
    if not 0 <= test_size < 1 or not 0 <= val_size < 1:
        raise ValueError("test_size and val_size must be in [0, 1)")
    cls = c(label_col) if label_col else F.lit(_ALL)
    counts = save_table(df.groupBy(cls.alias("_cls")).agg(F.count(F.lit(1)).alias("_n")), "classes")
    missing = counts.where("_cls is null").first()
    if missing:
        raise ValueError(f"label column {label_col!r} has {missing['_n']} NULL rows; fill or drop them before a stratified split")
    if counts.count() <= DRIVER_CLASSES:
        quotas = {k: list(v) for k, v in split_quotas({r["_cls"]: r["_n"] for r in counts.collect()}, test_size, val_size).items()}
    else:
        quotas = quota_table(counts, test_size, val_size)
    return quota_assign(df, key_col, cls, quotas, ["test", "val"], "train", seed, split_col)


def random_split(df: DataFrame, key_col: str, test_size: float = 0.3, val_size: float = 0.2,
                 seed: int = 42, split_col: str = "split") -> DataFrame:
    return stratified_split(df, key_col, None, test_size, val_size, seed, split_col)


def split_class_distribution(df: DataFrame, label_col: str, split_col: str = "split") -> DataFrame:
    """(split, class, count, percent of the split), by split then class."""
    per = df.groupBy(c(split_col).alias("split"), c(label_col).alias("class")).agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("split")  # one row per class
    return per.withColumn("percent", F.col("count") * F.lit(100.0) / F.sum("count").over(w)) \
        .orderBy("split", "class")
