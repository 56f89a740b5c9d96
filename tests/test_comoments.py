"""Correlations of wide tables against numpy over the pairwise-complete rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import comoments, corr


def frame(spark, x):
    """A table of x with NULL for NaN, built from one array column."""
    rows = [(int(i), [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    return df.select(*[F.col("v")[k].alias(f"c.{k}") for k in range(x.shape[1])])


def pairwise(x):
    d = x.shape[1]
    out = np.full((d, d), np.nan)
    for i in range(d):
        both = ~np.isnan(x[:, i])[:, None] & ~np.isnan(x)
        n = both.sum(0)
        a = np.where(both, x[:, i][:, None], 0)
        b = np.where(both, x, 0)
        with np.errstate(all="ignore"):
            am, bm = a.sum(0) / n, b.sum(0) / n
            ad, bd = np.where(both, a - am, 0), np.where(both, b - bm, 0)
            den = np.sqrt((ad * ad).sum(0) * (bd * bd).sum(0))
            out[i] = np.where((den > 1e-9) & (n > 1), (ad * bd).sum(0) / den, np.nan)
    return out


def table(n, d, gaps=0.15, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 12))
    x = base @ rng.normal(size=(12, d)) + rng.normal(size=(n, d)) + rng.normal(0, 1e4, d)
    x[rng.random(x.shape) < gaps] = np.nan
    x[:, 3] = 0.1                                     # constant
    x[:, 5] = np.nan                                  # empty
    x[:, 7] = np.where(np.arange(n) == 2, 4.0, np.nan)  # one value
    x[:, 8] = x[:, 0]                                 # equal columns
    return x


def matrix(df, d):
    got = np.full((d, d), np.nan)
    rows = df.collect()
    assert len(rows) == d * d
    for r in rows:
        assert (r.col_a, r.col_b) == (f"c.{r.idx_a}", f"c.{r.idx_b}")
        got[r.idx_a, r.idx_b] = np.nan if r.r is None else r.r
    return got


def test_a_thousand_columns_with_gaps(spark):
    x = table(300, 1000)
    got, want = matrix(corr.corr_matrix(frame(spark, x)), 1000), pairwise(x)
    assert (np.isnan(got) == np.isnan(want)).all()
    assert np.nanmax(np.abs(got - want)) < 1e-9
    assert np.nanmax(np.abs(got - got.T)) == 0


def test_several_passes_and_odd_blocks(spark, monkeypatch):
    monkeypatch.setattr(comoments, "PASS_BYTES", 1)   # one stripe of blocks a pass
    x = table(120, 2 * comoments.BLOCK + 37, seed=2)
    got, want = matrix(corr.corr_matrix(frame(spark, x)), x.shape[1]), pairwise(x)
    assert (np.isnan(got) == np.isnan(want)).all() and np.nanmax(np.abs(got - want)) < 1e-9


def test_same_as_the_narrow_form(spark):
    x = table(200, 20, seed=3)
    df = frame(spark, x)
    narrow, wide = matrix(corr.corr_matrix(df), 20), matrix(comoments.wide_corr_matrix(df, df.columns), 20)
    assert (np.isnan(narrow) == np.isnan(wide)).all() and np.nanmax(np.abs(narrow - wide)) < 1e-9


@pytest.mark.parametrize("rows", [0, 1])
def test_few_rows(spark, rows):
    df = frame(spark, table(5, 60, gaps=0, seed=4)).limit(rows)
    assert np.isnan(matrix(corr.corr_matrix(df), 60)).all()
