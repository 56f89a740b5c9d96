"""The data-parallel network: gradients, row weights, settings, and what it learns."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import network
from tabprep.operators.network import NetworkClassifier
from tabprep.operators.train import ModelConfig, ModelType, assemble, build_model, fit, score

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def ring(spark):
    rnd = random.Random(4)
    rows = []
    for k in range(1500):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((k, a, b, int(a * a + b * b > 1.4), float(rnd.randint(0, 3))))
    return spark.createDataFrame(rows, "id int, a double, b double, y int, w double").repartition(6).cache()


def features(df):
    return assemble(df, FEATURES).withColumn("label", F.col("y"))


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    sizes = (3, 5, 4, 1)
    flat = network.initial(sizes, 2) + rng.normal(0, 0.1, 3 * 5 + 5 + 5 * 4 + 4 + 5)
    x, y, w = rng.normal(size=(20, 3)), (rng.random(20) < 0.5).astype(float), rng.integers(0, 4, 20).astype(float)
    g, loss = network.gradient(flat, sizes, x, y, w)
    for k in range(len(flat)):
        step = np.zeros_like(flat)
        step[k] = 1e-6
        up, down = (network.gradient(flat + s, sizes, x, y, w)[1] for s in (step, -step))
        assert g[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)
    p = network.forward(flat, sizes, x)
    assert loss == pytest.approx(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


def test_weights_equal_replicated_rows(ring):
    copies = ring.select("*", F.explode(F.when(F.col("w") > 0, F.sequence(F.lit(1), F.col("w").cast("int"))).otherwise(F.array().cast("array<int>"))).alias("k"))
    net = lambda **k: NetworkClassifier((8, 4), epochs=15, learning_rate=0.05, batch_size=None, seed=3, **k)
    weighted = net(weight_col="w").fit(features(ring))
    copied = net().fit(features(copies))
    assert np.allclose(weighted.flat, copied.flat, rtol=1e-9, atol=1e-12) and np.allclose(weighted.losses, copied.losses)
    assert not np.allclose(weighted.flat, net().fit(features(ring)).flat, atol=1e-3)


def test_sums_in_groups_change_nothing(ring, monkeypatch):
    many = features(ring.repartition(12))
    net = NetworkClassifier((4,), epochs=4, learning_rate=0.05, batch_size=None)
    want = net.fit(many).flat
    monkeypatch.setattr(network, "GROUPS", 3)
    assert np.allclose(net.fit(many).flat, want, rtol=1e-9)


@pytest.mark.parametrize("dropout", [0.0, 0.2])
def test_learns_what_a_line_cannot(ring, dropout):
    train, test = ring.where("id % 4 > 0"), ring.where("id % 4 = 0")
    cfg = ModelConfig(ModelType.NEURAL_NETWORK, "net", params={"layers": [16, 8], "epochs": 25, "learning_rate": 0.02, "batch_size": 32, "dropout_rate": dropout})
    model, _ = fit(cfg, train, FEATURES, "y")
    assert model.losses[-1] < 0.6 * model.losses[0] and len(model.losses) == 25
    got = score(model, test, FEATURES, keep=["y"])
    assert got.where("prediction = y").count() > 0.88 * got.count()
    again, _ = fit(cfg, train, FEATURES, "y")
    assert np.allclose(again.flat, model.flat)


def test_class_weights_move_the_threshold(ring):
    cfg = ModelConfig(ModelType.NEURAL_NETWORK, "net", params={"layers": [8], "epochs": 6, "learning_rate": 0.02, "batch_size": 64})
    share = lambda weights: score(fit(cfg, ring, FEATURES, "y", weights)[0], ring, FEATURES).agg(F.avg("prediction")).first()[0]
    assert share({0: 1.0, 1: 8.0}) > share(None) + 0.1


def test_every_setting_counts_or_is_refused(ring):
    with pytest.raises(ValueError, match="does not take dropout"):
        build_model(ModelConfig(ModelType.NEURAL_NETWORK, "n", params={"dropout": 0.3}), 2)
    with pytest.raises(ValueError, match="n_jobs"):
        build_model(ModelConfig(ModelType.RANDOM_FOREST, "r", params={"n_jobs": 4}), 2)
    with pytest.raises(ValueError, match="min_samples_split"):
        build_model(ModelConfig(ModelType.RANDOM_FOREST, "r", params={"min_samples_split": 30, "min_samples_leaf": 5}), 2)
    assert build_model(ModelConfig(ModelType.RANDOM_FOREST, "r", params={"min_samples_split": 10, "min_samples_leaf": 5}), 2)
    for bad in ({"dropout_rate": 1.0}, {"learning_rate": 0}, {"epochs": 0}, {"layers": [0]}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            build_model(ModelConfig(ModelType.NEURAL_NETWORK, "n", params=bad), 2)
    slow, fast = (NetworkClassifier((4,), epochs=3, learning_rate=r, batch_size=None).fit(features(ring)).losses for r in (1e-5, 0.05))
    assert slow[0] == fast[0] and fast[-1] < slow[-1]
    with pytest.raises(ValueError, match="no rows"):
        NetworkClassifier().fit(features(ring.where("id < 0")))
