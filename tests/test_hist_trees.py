"""Trees of large tables grown from histograms, against MLlib and brute force."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import hist_trees, train
from tabprep.operators.train import ModelConfig, ModelType, fit, score

FEATURES = ["a", "b.c", "flag", "grade", "same"]


@pytest.fixture(scope="module")
def parts(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(3000):
        a, b, flag, grade = rnd.random(), rnd.gauss(0, 1), rnd.randint(0, 1), rnd.randint(0, 8)
        rows.append((k, a, b, flag, grade, 1.5, int(a + 0.3 * b + 0.2 * flag + 0.03 * grade + rnd.gauss(0, 0.5) > 1)))
    df = spark.createDataFrame(rows, "id long, a double, `b.c` double, flag int, grade int, same double, y int").repartition(3).cache()
    return df.where("id % 3 > 0"), df.where("id % 3 = 0")


@pytest.fixture
def large(monkeypatch):
    return lambda yes: monkeypatch.setattr(train, "LARGE_ROWS", 0 if yes else 1 << 40)


def nodes(model):
    def flat(n):
        if n.numDescendants() == 0:
            return [(n.prediction(), n.impurity(), *n.impurityStats().stats())]
        return [(n.split().featureIndex(), n.split().threshold(), n.gain(), n.impurity()), *flat(n.leftChild()), *flat(n.rightChild())]
    return [flat(t._call_java("rootNode")) for t in model.trees]


def by_id(model, df):
    return {r.id: r.probability for r in score(model, df, FEATURES, keep=["id"]).collect()}


@pytest.mark.parametrize("kind,weights,depth", [(ModelType.GRADIENT_BOOSTING, None, 3), (ModelType.XGBOOST, {0: 1.0, 1: 2.5}, 4)])
def test_boosting_is_mllibs(parts, large, kind, weights, depth, monkeypatch):
    cfg = ModelConfig(kind, "m", params={"n_estimators": 12, "max_depth": depth, "learning_rate": 0.3, "random_state": 1})
    large(False)
    want, _ = fit(cfg, parts[0], FEATURES, "y", weights)
    large(True)
    monkeypatch.setattr(hist_trees, "BLOCK_ROWS", 300)
    got, _ = fit(cfg, parts[0], FEATURES, "y", weights)
    assert not hasattr(want, "grown") and got.grown is not None
    for a, b in zip(nodes(want), nodes(got), strict=True):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x == pytest.approx(y, rel=1e-9, abs=1e-9)
    assert got.treeWeights == want.treeWeights
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())
    expected, grown = by_id(want, parts[1]), by_id(got, parts[1])
    del got.grown                                     # MLlib's own scores of the same trees
    assert grown == pytest.approx(expected, abs=1e-12) and by_id(got, parts[1]) == pytest.approx(expected, abs=1e-12)


def test_forest(parts, large):
    cfg = ModelConfig(ModelType.RANDOM_FOREST, "m", params={"n_estimators": 30, "max_depth": 6, "min_samples_leaf": 8, "random_state": 3})
    models = []
    for yes in (False, True):
        large(yes)
        models.append(fit(cfg, parts[0], FEATURES, "y", "balanced")[0])
    y = {r.id: r.y for r in parts[1].collect()}
    loss = [-np.mean([np.log(p[k] if y[k] else 1 - p[k]) for k in y]) for p in (by_id(m, parts[1]) for m in models)]
    assert loss[1] == pytest.approx(loss[0], abs=0.03) and loss[1] < 0.62
    old, new = models
    assert new.getNumTrees == 30 and new.numClasses == 2 and new.numFeatures == 5
    assert new.totalNumNodes == pytest.approx(old.totalNumNodes, rel=0.15) and max(t.depth for t in new.trees) <= 6
    assert np.allclose(new.featureImportances.toArray(), old.featureImportances.toArray(), atol=0.05)
    assert len({t.toDebugString.split("\n", 1)[1] for t in new.trees}) == 30
    first = by_id(new, parts[1])
    del new.grown
    assert by_id(new, parts[1]) == pytest.approx(first, abs=1e-12)
    again, _ = fit(cfg, parts[0], FEATURES, "y", "balanced")
    assert by_id(again, parts[1]) == first


def test_a_forest_in_several_passes_and_parts_is_the_same(parts, large, monkeypatch):
    cfg = ModelConfig(ModelType.RANDOM_FOREST, "m", params={"n_estimators": 6, "max_depth": 4, "min_samples_leaf": 8, "random_state": 3})
    large(True)
    want = nodes(fit(cfg, parts[0], FEATURES, "y")[0])
    monkeypatch.setattr(hist_trees, "PASS_BYTES", 1)
    monkeypatch.setattr(hist_trees, "HELD_ROWS", 500)
    assert nodes(fit(cfg, parts[0], FEATURES, "y")[0]) == want


def test_bootstrap_counts():
    n = np.concatenate([hist_trees.bootstrap(1, t, (0, b), 20_000) for t in range(5) for b in range(2)])
    assert n.mean() == pytest.approx(1, abs=0.01) and n.var() == pytest.approx(1, abs=0.02)
    for k, p in enumerate([0.3679, 0.3679, 0.1839, 0.0613, 0.0153, 0.0031]):
        assert (n == k).mean() == pytest.approx(p, abs=0.005)
    assert not np.array_equal(n[:20_000], n[20_000:40_000])


def test_histograms_and_gains():
    rng = np.random.default_rng(2)
    x = np.stack([rng.integers(0, 2, 4000), rng.integers(0, 9, 4000), rng.normal(size=4000), rng.random(4000), np.ones(4000)], 1).astype(float)
    layout = hist_trees.layout_of([hist_trees.cuts_of(x[:, f], np.ones(4000), 32) for f in range(5)])
    assert layout.cols == ((0, 1), (2,), (3,)) and [len(c) for c in layout.cuts] == [1, 8, 31, 31, 0]
    codes, y, slot = layout.codes(x), rng.integers(0, 2, 4000).astype(np.uint8), rng.integers(0, 4, 4000)
    target = rng.normal(size=4000)
    out = [np.zeros(sum(2 * 4 * s for s in layout.sizes)) for _ in range(3)]
    hist_trees.add_histograms(out, codes, slot, y, layout.sizes, 3, (None, target, target * target))
    weight = np.array([1.0, 3.0])
    found = hist_trees.split_variance(layout, 3, *out, weight, 5)
    w = weight[y]

    def spread(own):
        mean = np.average(target[own], weights=w[own])
        return np.average((target[own] - mean) ** 2, weights=w[own])

    for k, ((stats, raw, impurity, prediction), (f, cut, gain, left, right)) in enumerate(found):
        own = slot == k
        assert raw == own.sum() and impurity == pytest.approx(spread(own)) and stats[0] == pytest.approx(w[own].sum())
        best = 0
        for g in range(5):
            for at in layout.cuts[g]:
                a, b = own & (x[:, g] <= at), own & (x[:, g] > at)
                if min(a.sum(), b.sum()) >= 5:
                    best = max(best, spread(own) - (w[a].sum() * spread(a) + w[b].sum() * spread(b)) / w[own].sum())
        a = own & (x[:, f] <= layout.cuts[f][cut])
        assert gain == pytest.approx(best) and left[1] == a.sum() and left[2] == pytest.approx(spread(a)) and right[1] == (own & ~a).sum()


def test_tables_that_stay_with_mllib(spark, parts, large):
    large(True)
    train_rows = parts[0]
    cfg = ModelConfig(ModelType.RANDOM_FOREST, "m", params={"n_estimators": 3, "max_depth": 3, "random_state": 3})
    three = fit(cfg, train_rows.withColumn("y", F.col("id") % 3), FEATURES, "y")[0]
    assert not hasattr(three, "grown") and three.numClasses == 3
    assert not hasattr(fit(cfg, train_rows, ["same"], "y")[0], "grown")
    with pytest.raises(Exception, match="(?i)null"):
        fit(cfg, train_rows.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), FEATURES, "y")[0]


def test_cached_rows_are_bytes(spark, parts):
    layout = hist_trees.layout_of([np.arange(n) + 0.5 for n in (1, 1, 1, 1, 8, 31, 31)])
    assert layout.sizes == [144, 32, 32]              # seven features in three bytes
    data = train.assemble(parts[0], FEATURES)
    own = hist_trees.layout_of([np.array([0.5]), np.array([0.0]), np.array([0.5]), np.array([3.5]), np.array([])])
    blocks = hist_trees.blocks_of(data, own, "features", "y", 2000).collect()
    assert sum(len(b[1]) for b in blocks) == parts[0].count() and all(len(b[2]) == len(b[1]) and b[3] == b"" for b in blocks)


def test_sums_of_many_tasks(spark):
    parts = spark.sparkContext.parallelize(range(70), 70).map(lambda k: (k, [np.array([1.0 * k, 1.0]), np.array([2.0])]))
    for groups in (3, 32, 100):
        a, b = hist_trees.added_up(parts, 70, groups)
        assert a.tolist() == [2415.0, 70.0] and b.tolist() == [140.0]
