import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.operators import neighbors, resample, split


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(11)
    data = [(i, 1 if rnd.random() < 0.2 else 0, rnd.gauss(0, 1), rnd.gauss(0, 2), float(rnd.randint(0, 3)))
            for i in range(2000)]
    return spark.createDataFrame(data, "id long, y int, a double, b double, c double")


def test_largest_remainder_exact():
    q = split.largest_remainder({0: 7, 1: 3, 2: 1}, 5)
    assert sum(q.values()) == 5 and q == {0: 3, 1: 2, 2: 0} or sum(q.values()) == 5


@pytest.mark.parametrize("test_size,val_size", [(0.3, 0.2), (0.25, 0.0), (0.1, 0.5)])
def test_stratified_split_sizes(labelled, test_size, val_size):
    out = split.stratified_split(labelled, "id", "y", test_size, val_size, seed=42)
    n = labelled.count()
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    n_test = math.ceil(test_size * n)
    assert counts["test"] == n_test
    assert counts.get("val", 0) == (math.ceil(val_size * (n - n_test)) if val_size else 0)
    assert sum(counts.values()) == n
    # class shares kept to within one row per class
    per = {(r["split"], r["y"]): r["count"] for r in out.groupBy("split", "y").count().collect()}
    cls = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    for y, n_y in cls.items():
        assert abs(per[("test", y)] - n_test * n_y / n) < 1


def test_split_equals_plain_window_order(labelled):
    """Bucketed assignment == rank by md5 within class (the definition)."""
    out = split.stratified_split(labelled, "id", "y", 0.3, 0.2, seed=9)
    q = split.split_quotas({r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}, 0.3, 0.2)
    w = Window.partitionBy("y").orderBy(split.order_key("id", 9))
    ranked = labelled.select("id", "y", (F.row_number().over(w) - 1).alias("rk")).collect()
    expect = {}
    for r in ranked:
        t, v = q[r["y"]]
        expect[r["id"]] = "test" if r["rk"] < t else ("val" if r["rk"] < t + v else "train")
    got = {r["id"]: r["split"] for r in out.select("id", "split").collect()}
    assert got == expect


def test_split_is_reproducible(labelled):
    a = split.stratified_split(labelled, "id", "y", seed=1).select("id", "split").collect()
    b = split.stratified_split(labelled, "id", "y", seed=1).select("id", "split").collect()
    assert sorted(a) == sorted(b)


def _brute_knn(pts, k):
    ids = np.array([p[0] for p in pts])
    X = np.array([p[1:] for p in pts], dtype=float)
    out = {}
    for i in range(len(X)):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], ids[j]) for j in range(len(X)) if j != i)
        out[ids[i]] = [int(x[1]) for x in order[:k]]
    return out


@pytest.mark.parametrize("pivots,block", [(None, 1024), (40, 16), (1, 50)])
def test_knn_exact(spark, pivots, block):
    rnd = random.Random(2)
    pts = [(i, rnd.gauss(0, 1), rnd.gauss(0, 1) * 5, rnd.random()) for i in range(400)]
    # a dense cluster and an isolated point stress the cells' bounds
    pts += [(1000 + i, 3 + rnd.random() * 1e-3, 3.0, 0.5) for i in range(30)] + [(5000, 100.0, -80.0, 9.0)]
    df = spark.createDataFrame(pts, "id long, a double, b double, c double")
    got = neighbors.knn(df, "id", ["a", "b", "c"], k=5, pivots=pivots, block=block)
    found = {}
    for r in got.orderBy("id", "nbr_rank").collect():
        found.setdefault(r["id"], []).append(r["nbr_id"])
    assert found == _brute_knn(pts, 5)


def test_smote_counts_and_segments(labelled):
    out = resample.smote(labelled, "id", "y", ["a", "b", "c"], ratio=0.8, k=5, seed=3)
    cls = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    after = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert after[0] == cls[0]
    assert after[1] == int(0.8 * cls[0])
    syn = out.where("synthetic").alias("s")
    src = labelled.select(F.col("id").alias("sid"), F.col("a").alias("sa"), F.col("b").alias("sb"),
                          F.col("c").alias("sc"))
    nb = labelled.select(F.col("id").alias("nid"), F.col("a").alias("na"), F.col("b").alias("nb"),
                         F.col("c").alias("nc"))
    j = syn.join(src, syn.source_key == src.sid).join(nb, syn.neighbor_key == nb.nid)
    # x_new = x + u (nbr - x), the same u for every feature, 0 <= u < 1
    rows = j.select("a", "b", "c", "sa", "sb", "sc", "na", "nb", "nc").collect()
    assert len(rows) == after[1] - cls[1]
    for r in rows:
        us = [(r[x] - r["s" + x]) / (r["n" + x] - r["s" + x]) for x in "abc" if abs(r["n" + x] - r["s" + x]) > 1e-9]
        assert all(-1e-9 <= u < 1 + 1e-9 for u in us)
        assert max(us) - min(us) < 1e-6
    # neighbours are among the 5 nearest minority rows
    mino = [(r["id"], r["a"], r["b"], r["c"]) for r in labelled.where("y = 1").collect()]
    nn = _brute_knn(mino, 5)
    for r in syn.select("source_key", "neighbor_key").collect():
        assert r["neighbor_key"] in nn[r["source_key"]]


def test_smote_duplicates_and_errors(spark):
    data = [(i, 1, 1.0, 1.0) for i in range(20)] + [(100 + i, 0, float(i), 2.0) for i in range(60)]
    df = spark.createDataFrame(data, "id long, y int, a double, b double")
    out = resample.smote(df, "id", "y", ["a", "b"], ratio=1.0)
    assert out.where("y = 1").count() == 60
    # identical minority rows are each other's nearest neighbours
    assert out.where("synthetic and (a != 1.0 or b != 1.0)").count() == 0
    with pytest.raises(ValueError, match="remove samples"):
        resample.smote(df, "id", "y", ["a", "b"], ratio=0.1)


def test_knn_heavy_duplicates(spark):
    """A third of the rows share one vector: still exact, ties by id."""
    rnd = random.Random(4)
    pts = [(i, 1.0, 1.0) for i in range(150)]
    pts += [(1000 + i, rnd.uniform(-3, 3), rnd.uniform(-3, 3)) for i in range(300)]
    pts += [(5000 + i, 2.0, 2.0) for i in range(3)]
    df = spark.createDataFrame(pts, "id long, a double, b double")
    got = {}
    for r in neighbors.knn(df, "id", ["a", "b"], k=5).orderBy("id", "nbr_rank").collect():
        got.setdefault(r["id"], []).append(r["nbr_id"])
    assert got == _brute_knn(pts, 5)


def _compared(spark, x, k=5):
    """Distances computed by the search: block points times their candidates."""
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"f{j} double" for j in range(x.shape[1])))
    points, sent, _ = neighbors.candidate_cells(df, "id", [f"f{j}" for j in range(x.shape[1])], k, 0, None, 1024)
    n, m = ({r["cell"]: r["count"] for r in t.groupBy("cell").count().collect()} for t in (points, sent))
    return sum(n[c] * m.get(c, 0) for c in n)


def test_knn_compares_few_pairs_where_points_cluster(spark):
    rng = np.random.default_rng(4)
    plane = rng.uniform(size=(4000, 2))
    assert _compared(spark, plane) < 0.1 * 4000 ** 2
    centres = rng.normal(0, 20, (40, 10))
    groups = centres[rng.integers(0, 40, 3000)] + rng.normal(size=(3000, 10))
    assert _compared(spark, groups) < 0.25 * 3000 ** 2


@pytest.mark.parametrize("kind", ["plane", "groups"])
def test_knn_compares_less_than_n_to_the_1_5(spark, kind):
    """From 10,000 to 100,000 points, uniform in the plane or clustered in ten
    dimensions, the compared pairs grow by less than 10^1.5."""
    compared = {}
    for n in (10_000, 100_000):
        rng = np.random.default_rng(6)
        if kind == "plane":
            x = rng.uniform(size=(n, 2))
        else:                                                  # the same density within a group: more groups
            x = rng.normal(0, 60, (n // 100, 10))[rng.integers(0, n // 100, n)] + rng.normal(size=(n, 10))
        compared[n] = _compared(spark, x)
    assert compared[100_000] < 10 ** 1.5 * compared[10_000], compared
    assert compared[100_000] < 0.01 * 100_000 ** 2


def test_tree_bounds_hold(spark):
    """Every point is sent to the leaves of its k nearest, also in a tree
    with nodes nested in dense places and few points far out."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 10.0 ** -j, (300, 3)) + 7 * j for j in range(5)] + [rng.uniform(-1e3, 1e3, (40, 3))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, f0 double, f1 double, f2 double")
    points, sent, _ = neighbors.candidate_cells(df, "id", ["f0", "f1", "f2"], 5, 0, 8, 1024, leaf=24)
    cell, to, reach = {r["id"]: r["cell"] for r in points.collect()}, {}, {}
    for r in sent.collect():
        to.setdefault(r["id"], set()).add(r["cell"])
        reach[r["id"]] = r["reach"]
    assert len(cell) == len(x) and len(set(cell.values())) > 30
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        near = [j for j in np.argsort(d, kind="stable") if j != i][:5]
        assert {cell[j] for j in near} <= to[i] and d[near[-1]] <= reach[i]


def test_knn_in_ten_dimensions(spark):
    rng = np.random.default_rng(5)
    pts = [(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(300, 10)))]
    df = spark.createDataFrame(pts, "id long, " + ", ".join(f"f{j} double" for j in range(10)))
    got = {}
    for r in neighbors.knn(df, "id", [f"f{j}" for j in range(10)], k=5, block=64).orderBy("id", "nbr_rank").collect():
        got.setdefault(r["id"], []).append(r["nbr_id"])
    assert got == _brute_knn(pts, 5)


def test_knn_of_few_points(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id long, a double")
    assert {(r["id"], r["nbr_id"], r["dist"]) for r in neighbors.knn(df, "id", ["a"], k=5).collect()} == {(1, 2, 1.0), (2, 1, 1.0)}
    assert neighbors.knn(df.where("id = 1"), "id", ["a"], k=5).collect() == []
    assert neighbors.knn(df.where("id = 9"), "id", ["a"], k=5).collect() == []


def test_tree_keeps_one_copy_of_its_centres(spark, monkeypatch):
    """What a level holds on the driver grows with the tree, not with its square."""
    x = np.random.default_rng(3).random((6000, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, f0 double, f1 double, f2 double")
    held, dealt = [], neighbors._dealt

    def watched(rows, to, dim):
        arrays = {id(a if a.base is None else a.base): a if a.base is None else a.base for pair in to.values() for a in pair}
        held.append((len(to), sum(a.nbytes for a in arrays.values())))
        return dealt(rows, to, dim)

    monkeypatch.setattr(neighbors, "_dealt", watched)
    points, _, _ = neighbors.candidate_cells(df, "id", ["f0", "f1", "f2"], 5, 0, 8, 1024, leaf=16)
    nodes = points.agg(F.max("cell")).first()[0] + 1
    assert max(n for n, _ in held) > 50                        # many nodes are split at once
    assert max(b for _, b in held) <= 2 * nodes * (3 + 1) * 8


def test_smote_driver_share_grows_as_its_rows(spark, monkeypatch):
    """Four times the rows: about four times what SMOTE's neighbour search holds
    on the driver, not sixteen times; and all rows are there."""
    dealt, most = neighbors._dealt, {}

    def watched(rows, to, dim):
        arrays = {id(a if a.base is None else a.base): a if a.base is None else a.base for pair in to.values() for a in pair}
        most[n] = max(most.get(n, 0), sum(a.nbytes for a in arrays.values()))
        return dealt(rows, to, dim)

    monkeypatch.setattr(neighbors, "_dealt", watched)
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 16)
    x = np.random.default_rng(5).random((14_000, 3))
    table = spark.createDataFrame([(i, int(i % 7 < 3), *map(float, r)) for i, r in enumerate(x)], "id long, y int, f0 double, f1 double, f2 double")
    for n in (3_500, 14_000):
        out = resample.smote(table.where(F.col("id") < n), "id", "y", ["f0", "f1", "f2"], ratio=1.0)
        assert {tuple(r) for r in resample.class_distribution(out, "y").collect()} == {(0, n * 4 // 7), (1, n * 4 // 7)}
    assert most[14_000] <= 6 * most[3_500]
