"""Stratified splits with more classes than the driver handles."""
import random

import pytest
from pyspark.sql import functions as F

from tabprep.operators import split


def quotas(table):
    return {r["_cls"]: (r["_cuts"][0], r["_cuts"][1] - r["_cuts"][0]) for r in table.collect()}


@pytest.mark.parametrize("sizes", [(0.3, 0.2), (0.25, 0.0), (0.0, 0.1), (0.001, 0.5)])
@pytest.mark.parametrize("kind", ["string", "int"])
def test_table_equals_the_driver_form(spark, sizes, kind):
    rnd = random.Random(1)
    counts = {k if kind == "int" else f"c{k}é": rnd.choice([1, 1, 2, 3, 3, 3, 7, 50, rnd.randint(1, 10 ** 6)]) for k in range(700)}
    df = spark.createDataFrame(list(counts.items()), f"_cls {kind}, _n long")
    assert quotas(split.quota_table(df, *sizes)) == split.split_quotas(counts, *sizes)


def test_large_counts_do_not_overflow(spark):
    counts = {"a": 3 * 10 ** 17, "b": 5 * 10 ** 17 + 1, "c": 7}
    df = spark.createDataFrame(list(counts.items()), "_cls string, _n long")
    got = split._shared_out(df, "_n", 10 ** 17 + 3, "q").collect()
    assert {r["_cls"]: r["q"] for r in got} == split.largest_remainder(counts, 10 ** 17 + 3)


def test_a_hundred_thousand_classes(spark, monkeypatch):
    monkeypatch.setattr(split, "class_totals", None)  # not collected
    n = 100_000
    df = spark.range(0, 3 * n, 1, 8).select(F.col("id").alias("k"), (F.col("id") % n).alias("y"))
    out = split.stratified_split(df, "k", "y", 0.3, 0.2)
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"test": 90_000, "val": 42_000, "train": 168_000}
    per = out.groupBy("y").agg(F.count_if(F.col("split") == "test").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    # 0.9 test rows a class: the first nine tenths of the classes get one
    assert per.where("t > 1 or v > 1").count() == 0
    assert per.where("t = 1").agg(F.min("y"), F.max("y"), F.count("*")).first() == (0, 89_999, 90_000)


def test_null_labels_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, y string")
    with pytest.raises(ValueError, match="1 NULL rows"):
        split.stratified_split(df, "k", "y")
