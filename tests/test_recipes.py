import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.functions import convert
from tabprep.operators import metrics
from tabprep.operators.train import score_with_function
from tabprep.sources.tables import csv_scan


def test_csv_scan_and_nan(spark):
    d = tempfile.mkdtemp(prefix="tabprep-csv-", dir="/tmp")
    path = os.path.join(d, "loan.csv")
    with open(path, "w") as f:
        f.write("credit.policy,purpose,int.rate\n1,debt,0.12\n0,NA,NaN\n1,,0.1\n")
    df = csv_scan(spark, path)
    assert df.columns == ["credit.policy", "purpose", "int.rate"]
    rows = df.orderBy(F.col("`int.rate`").desc_nulls_last()).collect()
    assert rows[0]["int.rate"] == 0.12 and rows[-1]["int.rate"] is None  # NaN became NULL


def test_convert(spark):
    df = spark.createDataFrame([("12.5", "2024-01-02 03:04:05", -1.0), ("x", "not a date", 3.0)],
                               "a string, b string, c double")
    out = df.select(convert.to_numeric(F.col("a")).alias("a"), convert.to_datetime(F.col("b")).alias("b"),
                    convert.sentinel_to_null(F.col("c"), [-1, 9999]).alias("c")).collect()
    assert out[0]["a"] == 12.5 and out[1]["a"] is None
    assert out[0]["b"] is not None and out[1]["b"] is None
    assert out[0]["c"] is None and out[1]["c"] == 3.0


def test_cost_benefit(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.2), (0, 0.1)], "label int, score double")
    sweep = metrics.threshold_sweep(df, thresholds=[0.5])
    r = metrics.cost_benefit(sweep, lambda t, fn, fp, tp, tn: fn * 500 + fp * 50).first()
    assert (r["fn"], r["fp"], r["cost"]) == (1, 1, 550)


def test_score_with_function(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(10)], "id long, a double, b double")
    out = score_with_function(df, ["a", "b"], lambda x: 1 / (1 + np.exp(-(x[:, 0] - 4.5))), keep=["id"])
    got = {r["id"]: (r["probability"], r["prediction"]) for r in out.collect()}
    assert got[0][1] == 0 and got[9][1] == 1
    assert got[4][0] == pytest.approx(1 / (1 + np.exp(0.5)))
