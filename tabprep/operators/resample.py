"""SMOTE oversampling of the minority class of a binary label.

New rows are added until ``minority / majority = ratio``:
``n_new = int(ratio * n_majority) - n_minority``.  Each synthetic row is
``x + u * (nbr - x)`` for a minority row x, one of its k nearest minority
rows nbr (ties by key) and u in [0, 1).

Everything is deterministic per key: which rows get one extra copy comes
from md5 order (``quota_assign``), the neighbour and u of copy j of row x
from md5 of key, j and seed, so a recomputed partition produces the same
rows.

Neighbours come from the exact ``neighbors.knn`` (ties by key), which
collapses repeated vectors first, so duplicates never create quadratic
candidate sets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c
from .neighbors import knn
from ..session import ensure_checkpoint_dir
from .split import class_totals, quota_assign

_U_HEX = 13  # 52 bits: a double holds them


def _drawn(stream: int, seed: int, digits: int):
    """A number from the first hex digits of md5("key:copy:seed:stream"): any
    engine with md5 draws the same."""
    text = F.concat_ws(":", F.col("_key").cast("string"), F.col("copy").cast("string"), F.lit(str(seed)), F.lit(str(stream)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


@dataclass(frozen=True)
class SmoteBasis:
    """The ratio-independent part of SMOTE: class counts and, for every
    minority row, its candidate neighbour list (checkpointed).  Fit once,
    then draw any number of ratios from it."""
    key_col: str
    label_col: str
    feature_cols: tuple
    minority: object
    n_minority: int
    n_majority: int
    rows: DataFrame  # _key, _f0.., _cand
    seed: int


def smote_basis(df: DataFrame, key_col: str, label_col: str, feature_cols: Sequence[str], k: int = 5,
                seed: int = 42, counts: dict | None = None) -> SmoteBasis:
    feats = list(feature_cols)
    counts = counts if counts is not None else class_totals(df, c(label_col))
    mi, _, n_mi, n_ma = _classes(counts)
    if n_mi <= k:
        raise ValueError(f"Expected n_neighbors <= n_samples: {k + 1} > {n_mi}")
    minority = df.where(c(label_col) == F.lit(mi)).select(
        c(key_col).alias("_key"), *[c(f).cast("double").alias(f"_f{i}") for i, f in enumerate(feats)])
    fcols = [f"_f{i}" for i in range(len(feats))]
    nulls = minority.where(F.exists(F.array(*[F.col(f) for f in fcols]), lambda v: v.isNull())).limit(1).count()
    if nulls:
        raise ValueError("SMOTE features must not contain missing values")

    # exact row-level neighbours (repeated vectors are collapsed inside knn)
    nn = knn(minority, "_key", fcols, k, seed)
    nbr = minority.select(F.col("_key").alias("nbr_id"), F.array(*[F.col(f) for f in fcols]).alias("nbr_x"))
    cand = (nn.join(nbr, "nbr_id")
            .groupBy(F.col("id").alias("_key"))
            .agg(F.array_sort(F.collect_list(F.struct("nbr_rank", F.col("nbr_id").alias("key"),
                                                       F.col("nbr_x").alias("x")))).alias("_c")))  # k per row
    rows = minority.join(cand, "_key").select(
        "_key", *fcols, F.transform("_c", lambda s: F.struct(s["key"].alias("key"), s["x"].alias("x"))).alias("_cand"))
    ensure_checkpoint_dir(df.sparkSession)
    return SmoteBasis(key_col, label_col, tuple(feats), mi, n_mi, n_ma, rows.checkpoint(), seed)


def _classes(counts: dict) -> tuple:
    if len(counts) != 2:
        raise ValueError(f"SMOTE needs exactly two classes, found {len(counts)}")
    (mi, n_mi), (ma, n_ma) = sorted(counts.items(), key=lambda kv: (kv[1], kv[0]))
    return mi, ma, n_mi, n_ma


def smote_from(df: DataFrame, basis: SmoteBasis, ratio: float) -> DataFrame:
    """Original rows of ``df`` plus the synthetic rows for ``ratio``."""
    n_new = int(ratio * basis.n_majority) - basis.n_minority
    if n_new < 0:
        raise ValueError("The specified ratio required to remove samples from the minority class "
                         "while trying to generate new samples.")
    orig = df.withColumn("synthetic", F.lit(False))
    if n_new == 0:
        return orig
    mi, seed, feats = basis.minority, basis.seed, list(basis.feature_cols)
    fcols = [f"_f{i}" for i in range(len(feats))]
    # copies per row: n_new // n_mi each, one more for the first n_new % n_mi rows in md5 order
    base, extra = divmod(n_new, basis.n_minority)
    rows = quota_assign(basis.rows, "_key", F.lit(mi), {mi: [extra]}, ["extra"], "base", seed, "_part")
    rows = rows.withColumn("_copies", F.lit(base) + (F.col("_part") == "extra").cast("int"))
    rows = rows.select("*", F.explode(F.when(F.col("_copies") > 0, F.sequence(F.lit(1), F.col("_copies")))
                                      .otherwise(F.array().cast("array<int>"))).alias("copy"))
    pick = _drawn(1, seed, 8) % F.size("_cand") + 1
    u = _drawn(2, seed, _U_HEX) / F.lit(16.0 ** _U_HEX)
    rows = rows.select("*", F.element_at("_cand", pick.cast("int")).alias("_nb"), u.alias("_u"))
    synth = rows.select(
        F.lit(None).cast(df.schema[basis.key_col].dataType).alias(basis.key_col),
        F.lit(mi).cast(df.schema[basis.label_col].dataType).alias(basis.label_col),
        *[(F.col(f) + F.col("_u") * (F.col("_nb.x")[i] - F.col(f))).alias(feats[i])
          for i, f in enumerate(fcols)],
        F.lit(True).alias("synthetic"), F.col("_key").alias("source_key"),
        F.col("_nb.key").alias("neighbor_key"), F.col("copy"))
    return orig.unionByName(synth, allowMissingColumns=True)


def smote(df: DataFrame, key_col: str, label_col: str, feature_cols: Sequence[str], ratio: float = 1.0,
          k: int = 5, seed: int = 42) -> DataFrame:
    """Original rows plus synthetic minority rows.

    Added columns: ``synthetic`` (bool), and for synthetic rows
    ``source_key``, ``neighbor_key``, ``copy``.  Synthetic rows carry the
    label and the features; their key and other columns are NULL.
    """
    counts = class_totals(df, c(label_col))
    _, _, n_mi, n_ma = _classes(counts)
    if int(ratio * n_ma) - n_mi < 0:
        raise ValueError("The specified ratio required to remove samples from the minority class "
                         "while trying to generate new samples.")
    if int(ratio * n_ma) == n_mi:
        return df.withColumn("synthetic", F.lit(False))
    return smote_from(df, smote_basis(df, key_col, label_col, feature_cols, k, seed, counts), ratio)


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """(class, count) -- used before and after resampling."""
    return df.groupBy(c(label_col).alias("class")).agg(F.count(F.lit(1)).alias("count"))
