import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import corr, imbalance, metrics, outliers, profile


@pytest.fixture(scope="module")
def preds(spark):
    rnd = random.Random(7)
    data = []
    for i in range(200):
        y = 1 if i < 40 else 0
        p = min(1.0, max(0.0, round(rnd.random() * 0.7 + (0.3 if y else 0.0), 2)))
        data.append((i, y, p))
    return spark.createDataFrame(data, "id int, label int, score double")


def _auc_pairs(pdf):
    pos = pdf[pdf.label == 1].score.to_numpy()
    neg = pdf[pdf.label == 0].score.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def test_auc_exact_vs_pairs(preds):
    assert metrics.roc_auc_value(preds) == pytest.approx(_auc_pairs(preds.toPandas()), rel=1e-12)


def test_perfect_classifier(spark):
    df = spark.createDataFrame([(0, 0.1)] * 50 + [(1, 0.9)] * 50, "label int, score double")
    r = metrics.roc_auc(df).first()
    assert r["roc_auc"] == 1.0 and r["grade"] == "Excellent discrimination ability"


def test_roc_and_pr_shapes(preds):
    roc = metrics.roc_curve(preds).collect()
    assert roc[0]["fpr"] == 0.0 and roc[0]["tpr"] == 0.0
    pts = sorted((r["fpr"], r["tpr"]) for r in roc)
    assert pts[-1] == (1.0, 1.0)
    assert all(0 <= x <= 1 and 0 <= y <= 1 for x, y in pts)
    pr = metrics.pr_curve(preds).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


def test_confusion_grid_fills_missing_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    cm = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    rep = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["accuracy"]["f1_score"] == pytest.approx(2 / 3)


def test_sweep_best_is_first_max(preds):
    sweep = metrics.threshold_sweep(preds, thresholds=[0.3, 0.5, 0.7])
    rows = sweep.orderBy("seq").collect()
    best = metrics.best_threshold(sweep).first()
    top = max(r["metric_value"] for r in rows)
    assert best["metric_value"] == top
    assert best["seq"] == min(r["seq"] for r in rows if r["metric_value"] == top)
    with pytest.raises(ValueError):
        metrics.threshold_sweep(preds, metric="recall_weighted")
    with pytest.raises(TypeError):
        metrics.threshold_sweep(preds, metric="nope")


def test_corr_constant_and_dotted_names(spark):
    rnd = random.Random(1)
    data = [(float(i), 2.0 * i + rnd.random(), 5.0, float(i % 2), rnd.random()) for i in range(100)]
    df = spark.createDataFrame(data, "`a.x` double, b double, k double, t double, z double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in corr.corr_matrix(df).collect()}
    assert m[("k", "k")] is None and m[("a.x", "k")] is None
    pdf = df.toPandas()
    assert m[("a.x", "b")] == pytest.approx(pdf["a.x"].corr(pdf["b"]))
    dropped_df, dropped = corr.drop_highly_correlated_features(df, "t", 0.7)
    assert dropped in (["a.x"], ["b"])
    assert dropped[0] not in dropped_df.columns


def test_outliers_and_imbalance(spark):
    vals = [float(x) for x in range(1, 21)] + [100.0, -50.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    r = outliers.detect_outliers(df, "v").first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert r["lower_bound"] == pytest.approx(q1 - 1.5 * (q3 - q1))
    assert r["total_outliers"] == 2 and r["percentage"] == "9.1%"
    ids = {x["id"] for x in outliers.outlier_rows(df, ["id"], ["v"]).collect()}
    assert ids == {20, 21}
    with pytest.raises(ValueError):
        outliers.analyze_outliers(df, method="zscore")
    lab = spark.createDataFrame([(0,)] * 990 + [(1,)] * 10, "y int")
    s = imbalance.check_imbalance(lab, "y", {0: "Paid", 1: "Default"}).first()
    assert s["severity"].startswith("Severe") and s["imbalance_ratio"] == "99.00:1" or s["severity"].startswith("Extreme")
    w = {r["class"]: r["weight"] for r in imbalance.class_weights(lab, "y").collect()}
    assert w[0] == pytest.approx(1000 / (2 * 990)) and w[1] == pytest.approx(1000 / (2 * 10))


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (2, " NA ", 1.0), (3, "a", 2.0), (4, None, 3.0)],
                               "id int, s string, v double")
    assert {r["column"]: r["null_count"] for r in profile.null_counts(df).collect()} == {"id": 0, "s": 1, "v": 1}
    assert profile.bad_value_counts(df).first()["bad_count"] == 1
    u = profile.unique_values(df, "id").first()
    assert (u["n_unique"], u["top_value"], u["top_count"]) == (3, "a", 2)
    first = [r["value"] for r in profile.first_seen_values(df, "id").orderBy("position").collect()]
    assert first == ["a", " NA ", None]
    ct = {(r["s"], r["v"]): r["count"] for r in profile.crosstab(df.na.fill({"v": 0.0}), "s", "v", dense=True).collect()}
    assert ct[("a", 0.0)] == 1 and ct[("a", 1.0)] == 0
    sparse = {(r["s"], r["v"]): r["count"] for r in profile.crosstab(df.na.fill({"v": 0.0}), "s", "v").collect()}
    assert sparse == {k: n for k, n in ct.items() if n}


def test_distinct_values_bucketed_matches_window(spark, monkeypatch):
    """Positions from the bucketed running count equal a plain row_number."""
    from pyspark.sql import Window
    import tabprep.operators.cumulative as cum
    rows = [(i, f"v{(i * 7919) % 500}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, s string")
    real = cum.running_totals
    monkeypatch.setattr(cum, "running_totals",
                        lambda *a, **k: real(*a, rows_per_bucket=40, **k))
    got = {r["value"]: r["position"] for r in profile.distinct_values(df, "id").collect()}
    first = df.groupBy("s").agg(F.min("id").alias("f"))
    ref = {r["s"]: r["p"] for r in first.select("s", F.row_number().over(Window.orderBy("f")).alias("p")).collect()}
    assert got == ref


def test_auc_counts_beyond_int32(spark):
    """P * N > 2^31 must not overflow (totals are longs, product in double)."""
    df = spark.range(100_000).select((F.col("id") % 2).cast("int").alias("label"),
                                     (F.col("id") / 100_000.0).alias("score"))
    auc = metrics.roc_auc_value(df)
    assert auc == pytest.approx(0.5, abs=1e-4)


def test_group_density_matches_numpy(spark):
    from tabprep.operators import hist
    rnd = random.Random(9)
    vals = [rnd.gauss(0, 1) for _ in range(300)]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    got = {r["point"]: (r["x"], r["density"]) for r in hist.group_density(df, "g", "v", grid_points=16).collect()}
    x = np.array(vals)
    h = x.std(ddof=1) * len(x) ** -0.2
    for p, (at, dens) in got.items():
        want = np.exp(-0.5 * ((x - at) / h) ** 2).sum() / (h * len(x) * np.sqrt(2 * np.pi))
        assert dens == pytest.approx(want, rel=1e-9)
    assert got[0][0] == pytest.approx(x.min()) and got[15][0] == pytest.approx(x.max())


def test_crosstab_wide(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), (None, "x")], "k string, c string")
    wide = {r["k"]: (r["x"], r["y"]) for r in profile.crosstab_wide(df, "k", "c").collect()}
    assert wide == {"a": (1, 1), "b": (1, 0)}


def test_report_of_more_classes_than_a_dense_matrix_takes(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(metrics, "_MAX_CLASSES", 20)
    rng = np.random.default_rng(3)
    y = rng.integers(0, 60, 3000)
    p = np.where(rng.random(3000) < 0.7, y, rng.integers(0, 70, 3000))
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(y, p)] + [(None, 1), (2, None)], "label int, prediction int")
    with pytest.raises(ValueError, match="20 classes"):
        metrics.confusion_matrix(df)
    cells = {(r["actual"], r["predicted"]): r["count"] for r in metrics.confusion_matrix(df, dense=False).collect()}
    assert sum(cells.values()) == 3000 and all(n == ((y == a) & (p == b)).sum() for (a, b), n in cells.items())
    got = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert len(got) == 70 + 3 and got["65"]["support"] == 0 and got["65"]["precision"] == 0
    for k in (0, 17, 59):
        tp = ((y == k) & (p == k)).sum()
        assert got[str(k)]["precision"] == pytest.approx(tp / (p == k).sum()) and got[str(k)]["recall"] == pytest.approx(tp / (y == k).sum())
    some = {r["class"]: r for r in metrics.classification_report(df, labels=[1, 2, 99]).collect()}
    assert set(some) == {"1", "2", "99", "accuracy", "macro avg", "weighted avg"} and some["99"]["support"] == 0
