"""Rows and values that must not get lost: NULL keys, NaN, wide fills, long
integers; early stopping and metric histories; shared-folder tables."""

import math
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.operators import clean, corr, groups, history, profile, split
from tabprep.operators.clean import FillStrategy
from tabprep.operators.cumulative import running_totals
from tabprep.session import drop_tables, save_table
from tabprep.streaming import stream


@pytest.mark.parametrize("size", [7, 10**9])
def test_running_totals_null_groups_and_half_weights(spark, size):
    df = spark.createDataFrame([(i, None if i % 2 else "g", i * 1.0, 0.5) for i in range(40)], "id int, g string, k double, w double")
    got = {r["id"]: (r["cum_w"], r["tot_w"]) for r in running_totals(df, "k", ["w"], ["g"], rows_per_bucket=size).collect()}
    w = Window.partitionBy("g").orderBy("k")
    ref = {r["id"]: (r["c"], 10.0) for r in df.select("id", F.sum("w").over(w).alias("c")).collect()}
    assert got == ref and len(got) == 40


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "k double, w int")
    assert running_totals(df, "k", ["w"]).collect() == []


def test_split_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None if i % 5 == 0 else i, i % 2, i) for i in range(100)], "k int, y int, x int")
    out = split.stratified_split(df, "k", "y").collect()
    assert len(out) == 100 and sorted(r["x"] for r in out) == list(range(100))
    assert sum(r["split"] == "test" for r in out) == 30
    with pytest.raises(ValueError, match="NULL"):
        split.stratified_split(df.withColumn("y", F.when(F.col("x") > 3, F.col("y"))), "x", "y")


def test_fill_value_widens_the_column(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    out = clean.clean_numeric_columns(df, ["a"], FillStrategy.VALUE, 0.5)
    assert out.dtypes == [("a", "double")] and [r["a"] for r in out.collect()] == [1.0, 0.5]
    out = clean.clean_numeric_columns(df, ["a"], FillStrategy.VALUE, 2**40)
    assert out.dtypes == [("a", "bigint")] and [r["a"] for r in out.collect()] == [1, 2**40]
    assert clean.clean_numeric_columns(df, ["a"], FillStrategy.VALUE, 7).dtypes == [("a", "int")]


def test_mode_keeps_long_integers(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(big, 1.5), (big, 1.5), (big - 1, 2.5), (None, None)], "a long, b double")
    assert clean.numeric_fill_values(df, ["a", "b"], FillStrategy.MODE) == {"a": big, "b": 1.5}


def test_nan_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "a double")
    assert sorted(r["a"] for r in clean.clean_numeric_columns(df, ["a"], FillStrategy.MEAN).collect()) == [1.0, 2.0, 3.0]
    assert clean.clean_numeric_columns(df, ["a"], FillStrategy.DROP).count() == 2
    df.write.parquet(str(tmp_path / "t.parquet"))
    from tabprep.sources.tables import read_table
    assert read_table(spark, str(tmp_path), "t").where("a is null").count() == 1


def test_sum_of_an_all_null_group_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    got = {r["g"]: r["v_sum"] for r in groups.group_agg_multi(df, "g", {"v": ["sum"]}, total=False).collect()}
    assert got == {"a": 0.0, "b": 2.0}


def test_crosstab_with_a_value_named_like_the_column(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "b"), ("x", "a")], "a string, b string")
    assert {(r["a"], r["b"]): r["count"] for r in profile.crosstab(df, "a", "b").collect()} == {("x", "a"): 2, ("y", "b"): 1}
    dense = {(r["a"], r["b"]): r["count"] for r in profile.crosstab(df, "a", "b", dense=True).collect()}
    assert dense == {("x", "a"): 2, ("x", "b"): 0, ("y", "a"): 0, ("y", "b"): 1}
    assert profile.crosstab(df.withColumn("b", F.lit(3)), "a", "b").dtypes[1] == ("b", "int")


def test_correlation_with_gaps_and_constants(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    rows = [(float(a), float(a + b), None if i % 7 == 0 else float(b), 1e9 + 5.0) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.corr_matrix(df).collect()}
    pdf = df.toPandas()[["a", "b", "c"]].astype(float).corr()
    for x in "abc":
        assert got[(x, "d")] is None
        for y in "abc":
            assert math.isclose(got[(x, y)], pdf.loc[x, y], abs_tol=1e-12)


def test_fitted_value_and_drop_on_a_table(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", None)], "s string, v double")
    fill = stream.fit_preparation(df, {}, FillStrategy.VALUE, ["v"], fill_value=9.0)
    assert sorted(r["v"] for r in fill.apply(df).collect()) == [1.0, 9.0]
    assert stream.fit_preparation(df, {}, FillStrategy.DROP, ["v"]).apply(df).count() == 1
    with pytest.raises(ValueError):
        stream.fit_preparation(df, {}, FillStrategy.VALUE, ["v"])


def _runs(spark, values, metric="val_f1"):
    return spark.createDataFrame([(i + 1, metric, v) for i, v in enumerate(values)], "round int, metric string, value double")


@pytest.mark.parametrize("values,mode,patience,want", [
    ([0.1, 0.2, 0.3, 0.3, 0.2, 0.9], "max", 2, (3, 0.3, 5, True)),
    ([0.1, 0.2, 0.3, 0.3, 0.2, 0.9], "max", 5, (6, 0.9, 6, False)),
    ([5.0, 4.0, 4.5, 4.2, 4.1, 1.0], "min", 3, (2, 4.0, 5, True)),
    ([0.5, float("nan"), None, 0.6], "max", 3, (4, 0.6, 4, False)),
    ([0.5, 0.4], "max", 1, (1, 0.5, 2, True)),
])
def test_early_stop(spark, values, mode, patience, want):
    r = history.early_stop(_runs(spark, values), "val_f1", mode, patience).first()
    assert (r["best_round"], r["best_value"], r["stop_round"], r["stopped"]) == want


def test_early_stop_min_delta_and_names(spark):
    r = history.early_stop(_runs(spark, [0.5, 0.52, 0.7, 0.71, 0.72]), patience=2, min_delta=0.1).first()
    assert (r["best_round"], r["stop_round"], r["stopped"]) == (3, 5, True)
    with pytest.raises(ValueError, match="unknown monitor"):
        history.early_stop(_runs(spark, [1.0]), "val_mse")
    with pytest.raises(ValueError, match="mode"):
        history.early_stop(_runs(spark, [1.0]), "val_f1", "best")
    assert history.monitor_mode("val_loss") == "min" and history.monitor_mode("auc") == "max"


def test_metric_history_by_hand(spark):
    rows = [(1, 1, 0.9, True), (1, 0, 0.6, True), (1, 0, 0.2, True), (1, 1, 0.4, False), (2, 1, 0.9, True)]
    df = spark.createDataFrame(rows, "round int, y int, p double, val boolean")
    got = {(r["round"], r["metric"]): r["value"] for r in history.metric_history(df, "y", "p", "round", "val").collect()}
    assert got[(1, "val_accuracy")] == pytest.approx(2 / 3) and got[(1, "val_auc")] == 1.0 and got[(1, "val_precision")] == 0.5
    assert got[(1, "recall")] == 0.0 and (1, "precision") not in got and (2, "val_auc") not in got
    with pytest.raises(ValueError):
        history.metric_history(df, "y", "p", metrics=["mse"])


def test_saved_tables_are_removed(spark):
    df = save_table(spark.range(3), "probe")
    path = df.inputFiles()[0].replace("file://", "")
    assert os.path.exists(path)
    assert drop_tables(spark) >= 1 and not os.path.exists(path)
