"""Pairwise-complete correlations of wide tables by blocked co-moments.

d columns have d(d-1)/2 pairs; as aggregate expressions they no longer compile
beyond some hundred columns.  With the values x (0 where missing, taken from
the column's centre) and the masks m (1 where present), four matrix products
hold all that Pearson's r of every pair needs, over the rows where both are
present: m'm (counts), x'm (sums), (x^2)'m (squares), x'x (products).  Tasks
add them up over their Arrow batches; partial sums of blocks of BLOCK x BLOCK
pairs are added up across tasks, and each block becomes rows.

A task holds PASS_BYTES of sums at most; a wider matrix takes several passes,
each over a stripe of its rows.  Input partitions are joined to one per core,
so partial sums grow with the cores and the columns, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c

BLOCK = 256
PASS_BYTES = 128 << 20
_BATCH = 2048                                         # rows multiplied at once
#: A variance below this share of the squared distance to the centre is rounding: the values are equal.
_EQUAL = 1e-12


def _values(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    """Rows x columns, NaN where missing."""
    for batch in batches:
        for k in range(0, batch.num_rows, _BATCH):
            part = batch.slice(k, _BATCH)
            yield np.stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(dim)], 1).astype(float)


def centres(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of each column (the value itself where all are equal), and whether
    all are equal.  One row per core reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = np.zeros(dim), np.zeros(dim), np.full(dim, np.inf), np.full(dim, -np.inf)
        for x in _values(batches, dim):
            there = ~np.isnan(x)
            n += there.sum(0)
            total += np.where(there, x, 0).sum(0)
            low, high = np.fmin(low, np.where(there, x, np.inf).min(0)), np.fmax(high, np.where(there, x, -np.inf).max(0))
        yield pa.RecordBatch.from_arrays([pa.array([np.stack([n, total, low, high]).tobytes()], pa.binary())], names=["s"])

    parts = [np.frombuffer(r.s, float).reshape(4, dim) for r in rows.mapInArrow(run, "s binary").toLocalIterator()]
    parts = parts or [np.stack([np.zeros(dim), np.zeros(dim), np.full(dim, np.inf), np.full(dim, -np.inf)])]
    n, total = sum(p[0] for p in parts), sum(p[1] for p in parts)
    low, high = np.min([p[2] for p in parts], 0), np.max([p[3] for p in parts], 0)
    flat = ~(low < high)
    return np.where(flat, np.where(n > 0, low, 0), total / np.maximum(n, 1)), flat


def _partial_sums(rows: DataFrame, centre: np.ndarray, first: int, last: int) -> DataFrame:
    """(bi, bj, sums): the four sums of the blocks whose rows are columns
    first..last; only blocks on and above the diagonal."""
    dim = len(centre)
    shared = rows.sparkSession.sparkContext.broadcast(centre)          # a number per column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of pair (i, j): count, sum of x_i, of x_j, of squares of x_i, of x_j, of products
        sums = np.zeros((6, last - first, dim - first))
        for x in _values(batches, dim):
            x = x - shared.value
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0)[:, first:], m[:, first:].astype(float)
            a, am = x[:, :last - first], m[:, :last - first]
            for k, (left, right) in enumerate(((am, m), (a, m), (am, x), (a * a, m), (am, x * x), (a, x))):
                sums[k] += left.T @ right
        out = [(i // BLOCK, j // BLOCK, np.ascontiguousarray(sums[:, i - first:min(i + BLOCK, last) - first, j - first:j - first + BLOCK]).tobytes())
               for i in range(first, last, BLOCK) for j in range(i, dim, BLOCK)]
        own = list(zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(own[0], pa.int32()), pa.array(own[1], pa.int32()), pa.array(own[2], pa.binary())], names=["bi", "bj", "sums"])

    return rows.mapInArrow(run, "bi int, bj int, sums binary")


def _correlations(s: np.ndarray, flat_i: np.ndarray, flat_j: np.ndarray) -> np.ndarray:
    n, xi, xj, xxi, xxj, xy = s
    with np.errstate(divide="ignore", invalid="ignore"):
        vi, vj = xxi - xi * xi / n, xxj - xj * xj / n
        r = (xy - xi * xj / n) / np.sqrt(vi * vj)
    bad = (n < 2) | (vi <= _EQUAL * xxi) | (vj <= _EQUAL * xxj) | flat_i[:, None] | flat_j[None, :]
    return np.where(bad, np.nan, np.clip(r, -1.0, 1.0))


def wide_corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(col_a, col_b, idx_a, idx_b, r) of all ordered pairs, as ``corr_matrix``."""
    dim, cores = len(names), df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(*[F.when(~F.isnan(c(n).cast("double")), c(n).cast("double")).alias(f"x{i}") for i, n in enumerate(names)]).coalesce(cores)
    centre, flat = centres(rows, dim)
    height = max(BLOCK, PASS_BYTES // (6 * 8 * dim) // BLOCK * BLOCK)   # rows of the matrix in one pass
    parts = [_partial_sums(rows, centre, first, min(first + height, dim)) for first in range(0, dim, height)]
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)

    def finish(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a block's partial sums come in batches, one row per core
        i0, j0 = int(key[0]) * BLOCK, int(key[1]) * BLOCK
        hi, hj = min(BLOCK, dim - i0), min(BLOCK, dim - j0)
        total = np.zeros((6, hi, hj))
        for pdf in batches:
            for raw in pdf["sums"]:
                total += np.frombuffer(raw, float).reshape(6, hi, hj)
        r = _correlations(total, flat[i0:i0 + hi], flat[j0:j0 + hj])
        i, j = np.meshgrid(np.arange(i0, i0 + hi), np.arange(j0, j0 + hj), indexing="ij")
        use = i <= j
        i, j, r = i[use], j[use], r[use]
        r = np.where((i == j) & ~np.isnan(r), 1.0, r)
        both = i < j
        yield pd.DataFrame({"idx_a": np.concatenate([i, j[both]]).astype("int32"), "idx_b": np.concatenate([j, i[both]]).astype("int32"), "r": np.concatenate([r, r[both]])})

    cells = sums.groupBy("bi", "bj").applyInPandas(finish, "idx_a int, idx_b int, r double")
    label = F.array(*[F.lit(n) for n in names])
    if rows.isEmpty():                                # no task made partial sums
        cells = df.sparkSession.range(dim * dim).select((F.col("id") / dim).cast("int").alias("idx_a"), (F.col("id") % dim).cast("int").alias("idx_b"), F.lit(None).cast("double").alias("r"))
    return cells.select(label[F.col("idx_a")].alias("col_a"), label[F.col("idx_b")].alias("col_b"), "idx_a", "idx_b", F.when(~F.isnan("r"), F.col("r")).alias("r"))
