import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions.columns import validate_columns
from tabprep.operators import encode, features, scale
from tabprep.operators.train import ModelConfig, ModelType, fit, score
from tabprep.plans import preparation, selection


@pytest.fixture(scope="module")
def loans(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(300):
        rows.append((i, rnd.uniform(0, 100), rnd.randint(0, 8), rnd.uniform(50, 900), rnd.uniform(9, 12),
                     rnd.uniform(1000, 9000), rnd.uniform(0, 30), rnd.choice(["debt", "card", "home"]),
                     1 if rnd.random() < 0.25 else 0))
    return spark.createDataFrame(rows, "id long, `revol.util` double, `inq.last.6mths` int, installment double, "
                                       "`log.annual.inc` double, `days.with.cr.line` double, dti double, "
                                       "purpose string, `not.fully.paid` int")


def test_loan_features_formulae(loans):
    ok, missing = features.validate_features_for_engineering(loans)
    assert ok and missing == []
    out = features.create_loan_features(loans).toPandas()
    assert np.allclose(out["credit_util_ratio"], out["revol.util"] / 100)
    assert (out["annual_inquiry_rate"] == out["inq.last.6mths"] * 2).all()
    assert np.allclose(out["debt_burden"], out["installment"] / np.exp(out["log.annual.inc"]))
    years = out["days.with.cr.line"] / 365.25
    risk = (out["credit_util_ratio"] * 0.3 + out["inq.last.6mths"] / 10 * 0.2 + out["dti"] / 30 * 0.3
            + (1 - np.clip(years / 20, 0, 1)) * 0.2)
    assert np.allclose(out["risk_score"], risk)
    assert ((out["high_debt"] == ((out["dti"] > 20) | (out["revol.util"] > 80)).astype(int))).all()


def test_validate_reports_missing_in_order(loans):
    ok, missing = features.validate_features_for_engineering(loans.drop("dti", "installment"))
    assert not ok and missing == ["installment", "dti"]


def test_one_hot_drop_first(loans):
    out = encode.one_hot(loans, target_col="not.fully.paid")
    assert [c for c in out.columns if c.startswith("purpose_")] == ["purpose_debt", "purpose_home"]
    assert "purpose" not in out.columns


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, "train"), (2.0, "train"), (3.0, "train"), (10.0, "test")], "x double, split string")
    out, model = scale.standard_scale(df, ["x"])
    got = {r["split"] + str(i): r["x"] for i, r in enumerate(out.collect())}
    assert model.stds[0] == pytest.approx(np.std([1, 2, 3]))
    assert sorted(v for k, v in got.items() if k.startswith("train")) == pytest.approx(
        [-1.224744871, 0.0, 1.224744871])


def test_prepare_and_train(loans):
    p = preparation.prepare_data(loans, "not.fully.paid", "id")
    n = loans.count()
    sizes = {r["split"]: r["count"] for r in p.data.groupBy("split").count().collect()}
    assert sizes["test"] == math.ceil(0.3 * n) and sum(sizes.values()) == n
    train = p.train.toPandas()
    feats = list(p.feature_names)
    assert np.allclose(train[feats].mean(), 0, atol=1e-9)
    cfg = ModelConfig(ModelType.LOGISTIC_REGRESSION, "lr", class_weight="balanced")
    model, secs = fit(cfg, p.train, feats, "not.fully.paid", "balanced")
    s = score(model, p.test, feats, keep=["id"])
    assert s.count() == sizes["test"]
    assert s.where((F.col("probability") < 0) | (F.col("probability") > 1)).count() == 0


def test_strategy_checks(loans):
    with pytest.raises(ValueError, match="Valid options"):
        selection.parse_strategy("oversample_everything")
    with pytest.raises(ValueError):
        selection.resample_for_strategy(loans, "id", "not.fully.paid", ["dti"], "none",
                                        class_weights={0: 1.0, 1: 3.0}, auto_calculate_weights=False)
    from tabprep.operators.train import build_model
    cfg = ModelConfig(ModelType.RANDOM_FOREST, "rf")
    cfg.model_type = "svm"
    with pytest.raises(ValueError, match="Unknown model type"):
        build_model(cfg, 3)


def test_early_stopping_stops(loans):
    from tabprep.operators.train import fit_with_early_stopping
    p = preparation.prepare_data(loans, "not.fully.paid", "id")
    cfg = ModelConfig(ModelType.GRADIENT_BOOSTING, "gb", params={"n_estimators": 80, "max_depth": 3,
                                                                 "learning_rate": 0.3, "random_state": 1})
    model, _ = fit_with_early_stopping(cfg, p.train, p.val, list(p.feature_names), "not.fully.paid", tol=0.01)
    assert 1 <= model.getNumTrees < 80  # random labels: validation loss stalls early
    with pytest.raises(ValueError):
        fit_with_early_stopping(ModelConfig(ModelType.RANDOM_FOREST, "rf"), p.train, p.val,
                                list(p.feature_names), "not.fully.paid")


def test_prepared_rows_are_spread_over_all_cores(spark, monkeypatch):
    rows = [(i, float(i % 7), "ab"[i % 2], int(i % 5 == 0)) for i in range(2000)]
    narrow = spark.createDataFrame(rows, "id long, x double, kind string, y int").coalesce(1)
    few = preparation.prepare_data(narrow, "y", "id").data
    monkeypatch.setattr(preparation, "SMALL_ROWS", 500)
    dealt = preparation.prepare_data(narrow, "y", "id").data
    cores = spark.sparkContext.defaultParallelism
    sizes = dealt.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == cores and min(sizes) > 0.8 * 2000 / cores
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, few.collect()))
    monkeypatch.setattr(preparation, "TASK_ROWS", 2000 // cores - 1)
    assert preparation.spread(narrow, 2000).rdd.getNumPartitions() == 2 * cores
