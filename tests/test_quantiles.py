"""Quantiles by bracket against numpy, the rows they shuffle, and their way out."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import outliers, quantiles
from tabprep.operators.quantiles import exact_percentiles

PROBS = [0.5, 0.0, 0.25, 0.99, 1.0]
NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(2)
    rows = [("hot", rnd.gauss(0, 1)) for _ in range(40_000)] + [("ties", float(rnd.randint(0, 3))) for _ in range(25_000)]
    rows += [(None, rnd.random()) for _ in range(500)] + [("one", 7.5), ("two", -1.0), ("two", 4.0), ("none", None), ("ends", -math.inf), ("ends", math.inf), ("ends", 0.0)]
    return spark.createDataFrame(rows, "`g.x` string, `v.x` double").repartition(8).cache()


def expected(table):
    groups = {}
    for r in table.collect():
        if r[1] is not None:
            groups.setdefault(r[0], []).append(r[1])
    return {g: [float(np.percentile(v, 100 * p)) for p in PROBS] for g, v in groups.items() if g != "ends"}


def got(df):
    return {r[0]: list(r[1:]) for r in df.collect() if r[0] != "ends"}


def close(a, b):
    assert set(a) == set(b)
    for g in a:
        assert np.allclose(a[g], b[g], rtol=1e-12, atol=1e-12), g


def test_equal_numpy_per_group(table):
    close(got(exact_percentiles(table, "v.x", PROBS, ["g.x"], NAMES)), expected(table))


def test_all_rows_and_no_rows(spark, table):
    own = [r[1] for r in table.where("`g.x` = 'hot'").collect()]
    row = exact_percentiles(table.where("`g.x` = 'hot'"), "v.x", PROBS, [], NAMES).first()
    assert np.allclose(list(row), [np.percentile(own, 100 * p) for p in PROBS])
    none = table.where("`v.x` > 1e9 and `v.x` < 2e9")
    assert list(exact_percentiles(none, "v.x", [0.5], [], ["m"]).first()) == [None]
    assert exact_percentiles(none, "v.x", [0.5], ["g.x"], ["m"]).collect() == []


def test_a_wrong_sketch_changes_nothing(table, monkeypatch):
    monkeypatch.setattr(quantiles, "MARGIN", -0.2)    # brackets that miss their ranks
    monkeypatch.setattr(quantiles, "SMALL", 10)
    close(got(exact_percentiles(table, "v.x", PROBS, ["g.x"], NAMES)), expected(table))


def test_many_groups_are_ranked_in_full(table, monkeypatch):
    monkeypatch.setattr(quantiles, "BRACKET_BYTES", 0)
    close(got(exact_percentiles(table, "v.x", PROBS, ["g.x"], NAMES)), expected(table))


def test_only_the_bracket_is_shuffled(spark):
    n = 400_000
    df = spark.range(0, n, 1, 8).select((F.col("id") % 2).alias("g"), F.rand(3).alias("_v"))
    bounds = quantiles.brackets(df, ["g"], [0.25, 0.5, 0.75])
    counted = quantiles.cells(df, ["g"], bounds, 3)
    # per group and probability: twice the margin, and the sketch's own error on both sides
    assert counted.count() <= 2 * 3 * (n / 2) * (2 * quantiles.MARGIN + 4 / quantiles.ACCURACY) + 2 * 4
    assert counted.agg(F.sum("_w")).first()[0] == n
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_columns_at_once(spark):
    rnd = random.Random(5)
    rows = [(rnd.gauss(0, 9), rnd.randint(-5, 5) if k % 3 else None, None, float("nan") if k % 50 == 0 else 1.0 * k) for k in range(30_000)]
    df = spark.createDataFrame(rows, "`a.b` double, c int, empty double, n double")
    out = {r.column: (r.lo, r.hi) for r in quantiles.column_percentiles(df, ["a.b", "c", "empty", "n"], [0.75, 0.1], ["hi", "lo"]).collect()}
    assert set(out) == {"a.b", "c", "n"}
    for name, k in (("a.b", 0), ("c", 1)):
        own = [r[k] for r in rows if r[k] is not None]
        assert np.allclose(out[name], [np.percentile(own, 10), np.percentile(own, 75)])


def test_outliers_of_columns_without_values(spark):
    df = spark.createDataFrame([(k, float(k), None) for k in range(20)] + [(99, 500.0, None)], "id int, v double, e double")
    got = {r.column: r for r in outliers.analyze_outliers(df, exclude_columns=["id"]).collect()}
    assert got["v"].total_outliers == 1 and got["e"].total_outliers == 0 and got["e"].q1 is None
    assert [tuple(r) for r in outliers.outlier_rows(df, ["id"]).collect()] == [(99, "v", 500.0)]
    assert outliers.outlier_rows(df, ["id"], ["nothing"]).collect() == []
