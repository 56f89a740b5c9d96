import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions.distributions import betainc, f_sf, gammaincc
from tabprep.operators import groups


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(5)
    data = [(i, ["x", "y", "z"][i % 3] if i % 17 else None, rnd.gauss(i % 3, 1.0) if i % 11 else None)
            for i in range(600)]
    return spark.createDataFrame(data, "id int, g string, v double")


def _pdf(df):
    return df.toPandas()


def test_exact_percentiles_match_numpy(df):
    pdf = _pdf(df)
    got = {r["g"]: r for r in groups.group_percentiles(df, "g", "v").collect()}
    for g, part in pdf.dropna(subset=["g"]).groupby("g"):
        vals = part["v"].dropna().to_numpy()
        for p, name in zip((25, 50, 75, 90, 95), ("p25", "p50", "p75", "p90", "p95")):
            assert got[g][name] == pytest.approx(np.percentile(vals, p), rel=1e-12)


def test_exact_percentiles_bucketed_path(spark, df, monkeypatch):
    from tabprep.operators import quantiles
    from tabprep.operators.cumulative import running_totals
    monkeypatch.setattr(quantiles, "BRACKET_BYTES", 0)  # ranking in full, in ranges of 20 values
    monkeypatch.setattr(quantiles, "running_totals",
                        lambda *a, **k: running_totals(*a, rows_per_bucket=20, **k))
    pdf = _pdf(df)
    got = {r["g"]: r["p50"] for r in groups.group_percentiles(df, "g", "v").collect()}
    for g, part in pdf.dropna(subset=["g"]).groupby("g"):
        assert got[g] == pytest.approx(np.percentile(part["v"].dropna(), 50), rel=1e-12)


def test_group_stats_and_cv(df):
    st = groups.group_stats(df, "g", "v")
    pdf = _pdf(df).dropna(subset=["g"])
    for r in st.collect():
        part = pdf[pdf.g == r["g"]]["v"]
        assert r["count"] == part.count()
        assert r["mean"] == round(part.mean(), 2)
        assert r["std"] == round(part.std(ddof=1), 2)
        assert r["median"] == round(part.median(), 2)
    cv = groups.coefficient_of_variation(st).collect()
    assert all(r["cv"] == pytest.approx(r["std"] / r["mean"] * 100) for r in cv if r["mean"])


def test_total_row_sums_group_rows(df):
    out = {r["g"]: r for r in groups.group_mean_count_sum(df, "g", "v").collect()}
    groups_only = [v for k, v in out.items() if k != "Total"]
    assert out["Total"]["mean"] == pytest.approx(sum(r["mean"] for r in groups_only))
    assert out["Total"]["count"] == sum(r["count"] for r in groups_only)


def test_anova_against_definition(df):
    pdf = _pdf(df).dropna()
    parts = [p["v"].to_numpy() for _, p in pdf.groupby("g")]
    n, k = sum(len(p) for p in parts), len(parts)
    grand = np.concatenate(parts).mean()
    ssb = sum(len(p) * (p.mean() - grand) ** 2 for p in parts)
    ssw = sum(((p - p.mean()) ** 2).sum() for p in parts)
    f = (ssb / (k - 1)) / (ssw / (n - k))
    r = groups.anova_oneway(df, "g", "v").first()
    assert r["f_stat"] == pytest.approx(f, rel=1e-9)
    assert r["p_value"] == pytest.approx(f_sf(f, k - 1, n - k), rel=1e-9)
    assert r["significant"] == (r["p_value"] < 0.05)


def _f_sf_numeric(f, d1, d2, steps=200_000):
    """P(X > f) by integrating the F density (brute force)."""
    from math import lgamma, exp, log
    c = lgamma((d1 + d2) / 2) - lgamma(d1 / 2) - lgamma(d2 / 2) + (d1 / 2) * log(d1 / d2)
    xs = np.linspace(f, f + 400, steps)
    dens = np.exp(c + (d1 / 2 - 1) * np.log(xs) - ((d1 + d2) / 2) * np.log1p(d1 * xs / d2))
    return float(np.trapezoid(dens, xs))


@pytest.mark.parametrize("f,d1,d2", [(4.10, 2, 10), (3.1, 3, 20), (0.5, 4, 50), (2.2, 5, 995)])
def test_f_survival(f, d1, d2):
    assert f_sf(f, d1, d2) == pytest.approx(_f_sf_numeric(f, d1, d2), abs=2e-4)


def test_special_functions():
    # F(1, 1) is symmetric around 1 (heavy tail: no numeric integral here)
    assert f_sf(1.0, 1, 1) == pytest.approx(0.5, abs=1e-12)
    assert betainc(2.0, 3.0, 0.0) == 0.0 and betainc(2.0, 3.0, 1.0) == 1.0
    # I_x(1, 1) = x ; Q(1, t) = exp(-t)
    assert betainc(1.0, 1.0, 0.3) == pytest.approx(0.3)
    assert gammaincc(1.0, 2.5) == pytest.approx(math.exp(-2.5))
    assert f_sf(0.0, 3, 5) == 1.0 and f_sf(None, 3, 5) is None
    # huge d2 switches to the chi-square limit continuously
    assert f_sf(2.0, 4, 2e7 + 1) == pytest.approx(f_sf(2.0, 4, 9e6), rel=1e-3)


def test_variance_decomposition(df):
    everything = _pdf(df)
    pdf = everything.dropna(subset=["g"])
    r = groups.variance_decomposition(df, "g", "v").first()
    # total variance is over every row, NULL group keys included
    assert r["total_var"] == pytest.approx(everything["v"].var(ddof=1))
    rows = pdf.groupby("g").size()
    var = pdf.groupby("g")["v"].var(ddof=1)
    within = ((rows - 1) * var).sum() / (len(pdf) - 3)
    assert r["within_var"] == pytest.approx(within)
    k3 = groups.variance_decomposition(df, "g", "v", df_groups=3).first()
    assert k3["within_var"] == pytest.approx(within)
