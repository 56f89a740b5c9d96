"""Edge frames: empty, all-null column, one group, one class, constant
column, NaN mixed with NULL."""
import math

import pytest
from pyspark.sql import functions as F

from tabprep.functions.columns import nan_to_null
from tabprep.operators import groups, imbalance, metrics, outliers, profile
from tabprep.operators.clean import FillStrategy, clean_numeric_columns


def test_empty_frame(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert groups.group_stats(df, "g", "v").count() == 0
    assert groups.group_percentiles(df, "g", "v").count() == 0
    assert outliers.analyze_outliers(df).where("total_outliers > 0").count() == 0
    assert profile.unique_values(df).count() == 0  # no values: nothing to report


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert {r["column"]: r["null_count"] for r in profile.null_counts(df).collect()}["v"] == 2
    for st in (FillStrategy.MEAN, FillStrategy.MEDIAN, FillStrategy.MODE):
        assert [r["v"] for r in clean_numeric_columns(df, strategy=st).collect()] == [None, None]


def test_one_group_anova_is_undefined(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)], "g string, v double")
    r = groups.anova_oneway(df, "g", "v").first()
    assert r["n_groups"] == 1 and r["f_stat"] is None and r["p_value"] is None


def test_one_row_group_has_null_std(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "g string, v double")
    st = {r["g"]: r for r in groups.group_stats(df, "g", "v").collect()}
    assert st["a"]["std"] is None and st["b"]["std"] == pytest.approx(1.41)
    vd = groups.variance_decomposition(df, "g", "v").first()
    assert vd["within_var"] == pytest.approx(2.0 / (3 - 2))


def test_one_class(spark):
    df = spark.createDataFrame([(1,)] * 5, "y int")
    r = imbalance.check_imbalance(df, "y").first()
    assert r["n_classes"] == 1 and r["ratio"] == 1.0 and r["severity"].startswith("Balanced")
    scored = spark.createDataFrame([(1, 0.4), (1, 0.9)], "label int, score double")
    assert metrics.roc_auc(scored).first()["roc_auc"] is None  # no negatives: undefined, not an error


def test_nan_and_null_are_one_missing_value(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 5.0)], "id int, v double")
    assert profile.null_counts(df).where("column = 'v'").first()["null_count"] == 2
    clean = nan_to_null(df)
    assert clean.where(F.col("v").isNull()).count() == 2
    assert clean.agg(F.avg("v")).first()[0] == 5.0


def test_dotted_names_through_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 2.0)], "`grp.name` string, `val.ue` double")
    st = {r["grp.name"]: r["mean"] for r in groups.group_stats(df, "grp.name", "val.ue").collect()}
    assert st == {"x": 2.0, "y": 2.0}
