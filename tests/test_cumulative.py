"""running_totals must equal the plain window, also on its bucketed path."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.operators import cumulative
from tabprep.operators.cumulative import running_totals


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice(["a", "b", "c"]) if i % 10 else "hot", rnd.random(), rnd.randint(0, 5))
            for i in range(3000)]
    return spark.createDataFrame(data, "id int, g string, k double, w int")


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("rows_per_bucket", [10**9, 50])
def test_global(table, desc, rows_per_bucket):
    got = running_totals(table, "k", ["w"], descending=desc, rows_per_bucket=rows_per_bucket)
    order = F.col("k").desc() if desc else F.col("k")
    ref = table.select("id", F.sum("w").over(Window.orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)).alias("ref"))
    j = got.join(ref, "id")
    assert j.where(F.col("cum_w") != F.col("ref")).count() == 0
    assert j.select("tot_w").distinct().count() == 1


@pytest.mark.parametrize("rows_per_bucket", [10**9, 40])
def test_grouped(table, rows_per_bucket):
    got = running_totals(table, "k", ["w"], ["g"], rows_per_bucket=rows_per_bucket)
    ref = table.select("id", F.sum("w").over(Window.partitionBy("g").orderBy("k").rowsBetween(
        Window.unboundedPreceding, 0)).alias("ref"), F.sum("w").over(Window.partitionBy("g")).alias("tot"))
    j = got.join(ref, "id")
    assert j.count() == table.count()
    assert j.where((F.col("cum_w") != F.col("ref")) | (F.col("tot_w") != F.col("tot"))).count() == 0


@pytest.mark.parametrize("key", ["text", "day", "amount", "at"])
def test_keys_of_other_types(spark, key):
    rnd = random.Random(9)
    names = rnd.sample([f"{a}{b}é{k}" for a in "abAB " for b in "xyZ" for k in range(40)], 500)
    df = spark.createDataFrame([(i, rnd.choice(["a", None]), n, i) for i, n in enumerate(names)], "id int, g string, text string, w int")
    df = df.select("id", "g", F.when(F.col("id") > 1, F.col("text")).alias("text"), F.expr("date_add(date'1969-01-01', id * 7 % 500)").alias("day"),
                   F.expr("cast(id * 37 % 500 - 200.5 as decimal(12, 2))").alias("amount"), F.expr("timestamp_micros(id * 1000001L - 90000000L)").alias("at"), F.expr("cast(w as decimal(9, 3))").alias("w"))
    df = df.where("id <> 1 or g is null")
    got = running_totals(df, key, ["w"], ["g"], rows_per_bucket=30)
    ref = df.select("id", F.sum("w").over(Window.partitionBy("g").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)).alias("ref"))
    j = got.join(ref, "id")
    assert got.schema["cum_w"].dataType == ref.schema["ref"].dataType
    assert j.count() == df.count() and j.where("cum_w <> ref").count() == 0


def test_one_exchange_and_nothing_written(table, spark):
    from tabprep import session
    before = dict(session._written)
    got = running_totals(table, "k", ["w"], ["g"], rows_per_bucket=100)
    rows = table.count()
    assert session._written == before
    bounds = cumulative.range_bounds(table, "k", 100)
    assert 20 <= len(bounds) <= 30 and bounds == sorted(set(bounds))
    sizes = [r["count"] for r in cumulative.with_range(table, "k", bounds).groupBy("_b").count().collect()]
    assert sum(sizes) == rows and max(sizes) <= 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the rows (with their offsets) once, partial sums by range, their prefix sums; no join
    assert plan.count("Exchange ") <= 3 and "Join" not in plan


def test_as_many_ranges_as_a_large_table_needs(spark, monkeypatch):
    monkeypatch.setattr(cumulative, "RANGES", (4, 64))
    df = spark.range(1000).select("id", F.lit(1).alias("w"))
    assert 36 <= len(cumulative.range_bounds(df, "id", 25)) <= 40
    got = running_totals(df, "id", ["w"], rows_per_bucket=25)
    assert got.where("cum_w <> id + 1 or tot_w <> 1000").count() == 0 and got.count() == 1000
    assert running_totals(df.where("id < 0"), "id", ["w"]).count() == 0
