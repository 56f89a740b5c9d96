import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabprep.operators.clean import CaseStyle, FillStrategy
from tabprep.streaming import stream as S


@pytest.fixture(scope="module")
def folder(spark):
    d = tempfile.mkdtemp(prefix="tabprep-stream-", dir="/tmp")
    rows = [(i, [" a ", "NA", "b", None][i % 4], None if i % 5 == 0 else float(i), ["x", "y"][i % 2])
            for i in range(200)]
    spark.createDataFrame(rows, "id long, s string, v double, cat string").write.parquet(
        os.path.join(d, "t.parquet"))
    return d


def test_fitted_preparation_same_on_stream_and_batch(spark, folder):
    batch = spark.read.parquet(os.path.join(folder, "t.parquet"))
    prep = S.fit_preparation(batch, {"case_style": CaseStyle.UPPER}, FillStrategy.MEDIAN, ["v"],
                             categorical_cols=["cat"], scale_columns=["v"])
    expected = sorted(tuple(r) for r in prep.apply(batch).collect())
    live = S.read_table_stream(spark, folder, "t")
    assert live.isStreaming
    got = sorted(tuple(r) for r in S.run_available(prep.apply(live), "append").collect())
    assert got == expected
    # the case style applies to every text column, the category included
    assert "cat_Y" in prep.apply(batch).columns and "cat" not in prep.apply(batch).columns


def test_running_confusion_counts(spark, folder):
    live = S.read_table_stream(spark, folder, "t").select(
        (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 10 / 10.0).alias("score"))
    out = S.run_available(S.confusion_counts(S.score_stream(live, "score", 0.5)), "complete").first()
    assert out["tn"] + out["fp"] + out["fn"] + out["tp"] == 200
    assert 0 <= out["f1"] <= 1
