"""One-hot encoding with the first (alphabetical) category dropped.

Columns of up to ``max_categories`` categories become 0/1 columns; their
category lists are the only data that reach the driver.  A column with more
becomes one sparse vector column with the same meaning -- categories sorted,
the first dropped, a missing value all zeros -- by a distributed dictionary:
distinct values get their rank by a prefix scan (``running_totals``), rows get
it by a join, and nothing but the number of categories is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, string_columns
from ..session import save_table, table_bytes
from .cumulative import running_totals

MAX_CATEGORIES = 1000
#: Largest dictionary (in bytes as written) that is broadcast to the rows.
DICTIONARY_BYTES = 32 << 20


def categories(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list | DataFrame]:
    """Sorted non-null categories of each column: a list, or for columns with
    more than ``max_categories`` the ``category_index`` table."""
    if not columns:
        return {}
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("k"), c(n).cast("string").alias("v")) for n in columns])).alias("kv")
    ).select("kv.k", "kv.v").where(F.col("v").isNotNull())
    many = {r["k"] for r in pairs.groupBy("k").agg(F.approx_count_distinct("v", 0.01).alias("n")).collect() if r["n"] > 0.9 * max_categories}
    out: dict[str, list | DataFrame] = {n: [] for n in columns}
    few = [n for n in columns if n not in many]
    for r in pairs.where(F.col("k").isin(few)).distinct().collect() if few else []:
        out[r["k"]].append(r["v"])
    for n in few:
        out[n].sort()
    for n in many:
        index = category_index(df, n)
        if index.count() > max_categories:
            out[n] = index
        else:
            out[n] = [r["value"] for r in index.orderBy("rank").collect()]
    return out


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(value, rank): every non-null category as text and its place, from 0, in
    sorted order; a saved table, computed without collecting categories."""
    values = df.select(c(column).cast("string").alias("value")).where("value is not null").groupBy("value").agg(F.lit(1).alias("_one"))
    return save_table(running_totals(values, "value", ["_one"]).select("value", (F.col("cum__one") - 1).cast("int").alias("rank")), "categories")


def one_hot_index(df: DataFrame, column: str, index: DataFrame | None = None, out: str = "category") -> DataFrame:
    """Add the place of the row's one among the dummies of ``column``: 0 for
    the second category, and so on; NULL where all are zero (the first
    category, a missing value, one that ``index`` does not have).

    The dictionary is broadcast while its bytes allow it; else the join
    shuffles, and a value that holds many rows is split by the skew join."""
    index = category_index(df, column) if index is None else index
    found = index.where("rank > 0").select(F.col("value").alias("__value"), (F.col("rank") - 1).alias(out))
    found = F.broadcast(found) if table_bytes(index) <= DICTIONARY_BYTES else found
    return df.join(found, c(column).cast("string") == F.col("__value"), "left").drop("__value")


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, target_col: str | None = None,
            drop_first: bool = True, cats: dict[str, list | DataFrame] | None = None) -> DataFrame:
    """Replace each categorical column by 0/1 int columns ``{col}_{value}``
    (categories sorted, the first dropped), appended after the other
    columns; a missing value is all zeros.  A column with too many categories
    becomes one sparse vector column ``{col}_vec`` of the same dummies.
    Default columns: the string columns except the target.  ``cats`` reuses
    categories fitted earlier (e.g. on a training table), which also makes it
    streaming-safe."""
    cols = string_columns(df, columns)
    if columns is None and target_col in cols:
        cols.remove(target_col)
    if not cols:
        return df
    cats = cats if cats is not None else categories(df, cols)
    wide = [n for n in cols if isinstance(cats.get(n), DataFrame)]
    for n in wide:
        df = one_hot_vector(df, n, f"{n}_vec", cats[n], drop_first)
    keep = [c(n) for n in df.columns if n not in cols and n not in [f"{w}_vec" for w in wide]]
    dummies = []
    for n in cols:
        if n in wide:
            dummies.append(c(f"{n}_vec"))
            continue
        values = cats.get(n, [])
        for v in (values[1:] if drop_first else values):
            dummies.append(F.coalesce(c(n).cast("string") == F.lit(v), F.lit(False)).cast("int")
                           .alias(f"{n}_{v}"))
    return df.select(*keep, *dummies)


def one_hot_vector(df: DataFrame, column: str, output_col: str | None = None, index: DataFrame | None = None, drop_first: bool = True) -> DataFrame:
    """Add the dummies of one column as a sparse vector: a one at the place of
    the row's category, the first category (with ``drop_first``), missing
    values and categories that ``index`` does not have all zeros."""
    from pyspark.ml.feature import OneHotEncoder
    out = output_col or f"{column}_vec"
    index = category_index(df, column) if index is None else index
    size = index.count() - drop_first
    if size < 1:                                      # no dummies: a vector without places
        from pyspark.ml.functions import array_to_vector
        return df.withColumn(out, array_to_vector(F.array().cast("array<double>")))
    if drop_first:
        place = one_hot_index(df, column, index, "__place")
    else:
        all_ = index.select(F.col("value").alias("__value"), F.col("rank").alias("__place"))
        place = df.join(F.broadcast(all_) if table_bytes(index) <= DICTIONARY_BYTES else all_, c(column).cast("string") == F.col("__value"), "left").drop("__value")
    # the place after the last is the one that the encoder drops
    nominal = {"ml_attr": {"type": "nominal", "num_vals": int(size) + 1}}
    place = place.withColumn("__place", F.coalesce("__place", F.lit(int(size))).cast("double")).withMetadata("__place", nominal)
    return OneHotEncoder(inputCol="__place", outputCol=out, dropLast=True).fit(place).transform(place).drop("__place")
