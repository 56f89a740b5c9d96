"""Strategy search, model comparison and summary against figures recomputed in numpy."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import staged
from tabprep.operators.train import ModelConfig, ModelType, fit, score
from tabprep.plans import selection

FEATURES = ["a", "b", "noise"]


@pytest.fixture(scope="module")
def parts(spark):
    rnd = random.Random(6)
    rows = []
    for k in range(900):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((k, a, b, rnd.random(), int(a + 0.5 * b + rnd.gauss(0, 0.7) > 1.1)))
    df = spark.createDataFrame(rows, "id long, a double, b double, noise double, y int").cache()
    return df.where("id % 3 > 0"), df.where("id % 3 = 0")


def recomputed(model, val):
    got = np.array([(r.y, r.probability) for r in score(model, val, FEATURES, keep=["y"]).collect()])
    y, p = got[:, 0], got[:, 1]
    hit = p >= 0.5
    tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
    diff = p[y == 1][:, None] - p[y == 0]
    precision, recall = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn)
    return {"accuracy": (hit == (y == 1)).mean(), "precision": precision, "recall": recall, "f1": 2 * tp / (2 * tp + fp + fn), "roc_auc": (diff > 0).mean() + 0.5 * (diff == 0).mean()}


def close(row, want):
    for k, v in want.items():
        assert row[k] == pytest.approx(v, abs=1e-9), k


def test_strategies(spark, parts):
    train, val = parts
    builder = lambda: ModelConfig(ModelType.XGBOOST, "x", params={"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "random_state": 1})
    table, results = selection.optimize_strategy(builder, train, val, "id", "y", FEATURES, strategies=["none", "class_weights", "smote_partial", "smote_full"], smote_ratios=(0.5, 0.8), optimize_for="recall")
    rows = {r["name"]: r for r in table.collect()}
    assert set(rows) == {"none", "class_weights", "smote_partial@0.5", "smote_partial@0.8", "smote_full"}
    counts = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    for name, r in rows.items():
        close(r, recomputed(results[name].model, val))
        assert r["recall_weighted"] == pytest.approx(0.3 * r["roc_auc"] + 0.6 * r["recall"] + 0.1 * r["f1"])
        ratio = {"smote_partial@0.5": 0.5, "smote_partial@0.8": 0.8, "smote_full": 1.0}.get(name)
        assert r["n_before"] == sum(counts.values())
        assert r["n_after"] == (counts[0] + max(counts[1], int(ratio * counts[0])) if ratio else r["n_before"])
    ranked = sorted(rows.values(), key=lambda r: r["rank"])
    assert [r["recall"] for r in ranked] == sorted((r["recall"] for r in ranked), reverse=True)
    assert rows["class_weights"]["recall"] > rows["none"]["recall"]

    per = {r["strategy"]: r for r in selection.strategy_rows(results, val, FEATURES, "y").collect()}
    for name, res in results.items():
        auc = [recomputed(staged.truncated(res.model, k, spark), val)["roc_auc"] for k in range(1, 7)]
        assert per[name]["best_value"] == pytest.approx(max(auc)) and auc[per[name]["best_round"] - 1] == pytest.approx(max(auc))
        assert per[name]["train_samples"] == res.n_after and f"(0:{counts[0]:,})" in per[name]["class_distribution"]
    linear = {"lr": selection.train_with_strategy(ModelConfig(ModelType.LOGISTIC_REGRESSION, "l"), train, val, "id", "y", FEATURES, "none")}
    assert selection.strategy_rows(linear, val, FEATURES, "y").first()["best_round"] is None
    with pytest.raises(ValueError, match="validation"):
        selection.strategy_rows(linear, val, FEATURES, "y", monitor="auc")

    scored = score(results["none"].model, val, FEATURES, keep=["id", "y"])
    summary = selection.selection_summary(table, scored, "y", 0.4, "none")
    r = summary.first()
    got = np.array([(x.y, x.probability) for x in scored.collect()])
    hit = got[:, 1] >= 0.4
    assert (r["tp"], r["fp"]) == ((hit & (got[:, 0] == 1)).sum(), (hit & (got[:, 0] == 0)).sum())
    assert r["test_roc_auc"] == pytest.approx(rows["none"]["roc_auc"]) and r["val_roc_auc"] == pytest.approx(rows["none"]["roc_auc"])
    long = selection.all_results(summary, selection.strategy_rows(results, val, FEATURES, "y")).collect()
    assert {x["result"] for x in long} == {"best", "strategy"} and sum(x["metric"] == "best_round" for x in long) == 5


def test_a_fit_of_the_users_own(parts):
    train, val = parts
    seen = {}

    def own(data, validation, weights):
        seen.update(rows=data.count(), val=validation.count(), weights=weights)
        return fit(ModelConfig(ModelType.LOGISTIC_REGRESSION, "l"), data, FEATURES, "y", weights)[0]

    res = selection.train_with_strategy(None, train, val, "id", "y", FEATURES, "class_weights", train_fn=own)
    assert seen["rows"] == train.count() and seen["val"] == val.count() and seen["weights"][1] > seen["weights"][0]
    close(res.metrics, recomputed(res.model, val))


def test_compared_models_and_importance(parts):
    train, val = parts
    configs = [ModelConfig(ModelType.RANDOM_FOREST, "forest", params={"n_estimators": 8, "max_depth": 4, "min_samples_leaf": 5, "random_state": 1}),
               ModelConfig(ModelType.LOGISTIC_REGRESSION, "linear", class_weight="balanced"),
               ModelConfig(ModelType.NEURAL_NETWORK, "net", params={"layers": [8], "epochs": 8, "learning_rate": 0.02, "batch_size": 32})]
    table, results = selection.compare_models(configs, train, val, "y", FEATURES, optimize_for="roc_auc")
    rows = {r["name"]: r for r in table.collect()}
    for name, r in rows.items():
        close(r, recomputed(results[name].model, val))
        assert r["roc_auc"] > 0.8
    assert [r["name"] for r in sorted(rows.values(), key=lambda r: r["rank"])] == sorted(rows, key=lambda n: -rows[n]["roc_auc"])
    importance = {r["feature"]: r["importance"] for r in results["forest"].importance.collect()}
    assert set(importance) == set(FEATURES) and sum(importance.values()) == pytest.approx(1) and max(importance, key=importance.get) == "a" and min(importance, key=importance.get) == "noise"
    assert results["linear"].importance is None and results["net"].importance is None


def test_rows_are_scored_once(spark):
    scored_rows = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def proba(x):
        scored_rows.add(1)
        return x / 100

    rows = spark.range(100).select((F.col("id") % 3 == 0).cast("int").alias("the label"), proba(F.col("id").cast("double")).alias("probability"))
    scored = rows.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
    found = selection.validation_metrics(scored, "the label")
    assert scored_rows.value == 100
    assert found["accuracy"] == 0.5 and found["recall"] == 0.5
    assert found["roc_auc"] == pytest.approx(0.5, abs=0.02)
