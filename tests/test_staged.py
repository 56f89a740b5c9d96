"""Boosting round by round: staged margins, truncated ensembles, early stopping."""
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabprep.operators import history, staged
from tabprep.operators.train import ModelConfig, ModelType, assemble, fit, score
from tabprep.plans import selection

FEATURES = ["a", "b.c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = []
    for k in range(1200):
        a, b, d = rnd.random(), rnd.gauss(0, 1), float(rnd.randint(0, 4))
        data.append((k, a, b, d, int(a + 0.3 * b + rnd.gauss(0, 0.6) > 0.6)))
    df = spark.createDataFrame(data, "id int, a double, `b.c` double, d double, y int").cache()
    return df.where("id % 3 > 0"), df.where("id % 3 = 0")


def config(n=12, depth=3, rate=0.3):
    return ModelConfig(ModelType.GRADIENT_BOOSTING, "gb", params={"n_estimators": n, "max_depth": depth, "learning_rate": rate, "random_state": 1})


@pytest.fixture(scope="module")
def model(rows):
    return fit(config(), rows[0], FEATURES, "y")[0]


def test_last_margin_is_the_models(spark, rows, model):
    own = {r.id: r.margins for r in staged.staged_margins(model, rows[1], FEATURES, ["id"]).collect()}
    raw = model.transform(assemble(rows[1], FEATURES)).select("id", vector_to_array("rawPrediction")[1].alias("m"), vector_to_array("probability")[1].alias("p")).collect()
    assert len(own) == rows[1].count() and all(len(m) == 12 for m in own.values())
    for r in raw:
        assert own[r.id][-1] == pytest.approx(r.m / 2, abs=1e-12) or own[r.id][-1] == pytest.approx(r.m, abs=1e-12)
        assert 1 / (1 + math.exp(-2 * own[r.id][-1])) == pytest.approx(r.p, abs=1e-12)


@pytest.mark.parametrize("rounds", [1, 5, 12])
def test_a_round_equals_the_truncated_ensemble(spark, rows, model, rounds):
    cut = staged.truncated(model, rounds, spark)
    assert cut.getNumTrees == rounds
    want = {r.id: r.probability for r in score(cut, rows[1], FEATURES, keep=["id"]).collect()}
    got = staged.by_round(staged.staged_margins(model, rows[1], FEATURES, ["id"])).where(F.col("round") == rounds)
    for r in got.collect():
        assert r.probability == pytest.approx(want[r.id], abs=1e-12)
    # the same ensemble as a fit of that many rounds
    alone = {r.id: r.probability for r in score(fit(config(rounds), rows[0], FEATURES, "y")[0], rows[1], FEATURES, keep=["id"]).collect()}
    assert alone == pytest.approx(want)


def test_history_has_every_series(spark, rows, model):
    series = staged.fit_history(model, *rows, FEATURES, "y").collect()
    by = {(r["round"], r["metric"]): r["value"] for r in series}
    assert {m for _, m in by} == set(history.MONITORS) and {k for k, _ in by} == set(range(1, 13))
    # MLlib's own loss is twice the cross-entropy
    for name, df in (("loss", rows[0]), ("val_loss", rows[1])):
        own = model.evaluateEachIteration(assemble(df, FEATURES).withColumn("__label", F.col("y").cast("double")))
        assert [2 * by[k, name] for k in range(1, 13)] == pytest.approx(own, rel=1e-9)
    # one round from a truncated ensemble
    scored = [(r.y, r.probability) for r in score(staged.truncated(model, 4, spark), rows[1], FEATURES, keep=["y"]).collect()]
    y, p = np.array([s[0] for s in scored]), np.array([s[1] for s in scored])
    hit = p >= 0.5
    tp = (hit & (y == 1)).sum()
    pairs = (p[y == 1][:, None] > p[y == 0]).mean() + 0.5 * (p[y == 1][:, None] == p[y == 0]).mean()
    want = {"val_accuracy": (hit == (y == 1)).mean(), "val_precision": tp / hit.sum(), "val_recall": tp / y.sum(),
            "val_f1": 2 * tp / (hit.sum() + y.sum()), "val_auc": pairs}
    for name, value in want.items():
        assert by[4, name] == pytest.approx(value, rel=1e-9), name
    long = spark.createDataFrame(series)
    best = selection.best_epoch(long, "val_loss", "min").first()
    assert best.best_value == min(by[k, "val_loss"] for k in range(1, 13)) == by[best.best_round, "val_loss"]


@pytest.mark.parametrize("monitor,mode", [("val_loss", "min"), ("val_auc", "max"), ("val_f1", "auto")])
def test_stopping_by_any_series(rows, monitor, mode):
    found = staged.fit_until(config(40, 4, 0.5), *rows, FEATURES, "y", monitor=monitor, mode=mode, patience=3)
    own = [r["value"] for r in found.history.where(F.col("metric") == monitor).orderBy("round").collect()]
    better = min if monitor == "val_loss" else max
    assert len(own) == found.stop_round and found.best_value == better(own) and own.index(found.best_value) + 1 == found.best_round
    assert found.model.getNumTrees == found.best_round and found.stopped == (found.stop_round == found.best_round + 3)
    kept = staged.fit_until(config(6), *rows, FEATURES, "y", monitor=monitor, mode=mode, patience=50, restore_best_weights=False)
    assert not kept.stopped and kept.model.getNumTrees == kept.stop_round == 6


def test_settings_and_empty_rows(spark, rows, model):
    with pytest.raises(ValueError, match="unknown monitor"):
        staged.fit_until(config(), *rows, FEATURES, "y", monitor="val_mse")
    with pytest.raises(ValueError, match="boosting"):
        staged.fit_until(ModelConfig(ModelType.RANDOM_FOREST, "rf"), *rows, FEATURES, "y")
    with pytest.raises(ValueError, match="rounds"):
        staged.truncated(model, 13, spark)
    none = rows[1].where("id < 0")
    assert staged.staged_margins(model, none, FEATURES, ["id"]).collect() == []
    assert {r["metric"] for r in staged.fit_history(model, rows[0], none, FEATURES, "y").collect()} == set(staged.SERIES)


@pytest.mark.parametrize("counted", [1 << 21, 96])
def test_counted_margins_equal_the_rows_exploded_by_round(spark, rows, model, monkeypatch, counted):
    monkeypatch.setattr(staged, "_COUNTED", counted)
    both = rows[0].withColumn("v", F.lit(False)).unionByName(rows[1].withColumn("v", F.lit(True))).withColumn("y", F.when(F.col("id") % 11 > 0, F.col("y")))
    got = staged.staged_counts(model, both, FEATURES, "y", "v")
    assert got.groupBy("round").count().count() == 12
    if counted > 96:
        assert got.where("round = 1").count() < both.count()    # counted within the task, not a row per row and round
    keys = ["__val", "round", "margin"]
    total = {tuple(r) for r in got.groupBy(*keys).agg(F.sum("__pos"), F.sum("__neg")).collect()}
    exploded = staged.by_round(staged.staged_margins(model, both, FEATURES, ["y", "v"])).withColumnRenamed("v", "__val")
    assert total == {tuple(r) for r in exploded.groupBy(*keys).agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).collect()}
