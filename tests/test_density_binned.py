"""Binned kernel density within its stated error of the direct sum, and its plan."""
import math

import pytest
from pyspark.sql import functions as F

from tabprep.operators import hist


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(0, 6000, 1, 4).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b g").otherwise("c").alias("g.x"),
                                           (F.randn(3) * (F.col("id") % 3 + 1) + F.when(F.col("id") % 7 == 0, 8).otherwise(0)).alias("v"))
    return df.unionByName(spark.createDataFrame([("one", 4.0), ("flat", 2.0), ("flat", 2.0), ("none", None), (None, 1.0)], "`g.x` string, v double")).cache()


@pytest.mark.parametrize("bins", [64, 512])
def test_within_the_stated_error(table, bins):
    direct = {(r[0], r["point"]): (r["x"], r["density"]) for r in hist.group_density(table, "g.x", "v", 40).collect()}
    binned = {(r[0], r["point"]): (r["x"], r["density"]) for r in hist.group_density(table, "g.x", "v", 40, bins=bins).collect()}
    assert set(direct) == set(binned) and {g for g, _ in direct} == {"a", "b g", "c", "one", "flat"}
    st = {r[0]: r for r in table.where("v is not null and `g.x` is not null").groupBy("`g.x`").agg(F.count("*").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    worst = 0.0
    for (g, point), (x, density) in direct.items():
        h = (st[g]["s"] or 1.0) * st[g]["n"] ** -0.2
        w = (st[g]["hi"] - st[g]["lo"]) / (bins - 1)
        bound = (w / h) ** 2 / 8 / (h * math.sqrt(2 * math.pi))
        assert binned[g, point][0] == pytest.approx(x, abs=1e-12)
        assert abs(binned[g, point][1] - density) <= bound + 1e-12
        worst = max(worst, abs(binned[g, point][1] - density))
    assert worst > 0


def test_rows_are_not_multiplied(table, monkeypatch):
    """Every Generate of the plan is above the aggregate over the rows."""
    plan = hist.group_density(table, "g.x", "v", 64, bins=512)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    rows = next(k for k, line in enumerate(plan) if "InMemoryRelation" in line)
    above = plan[:rows]
    count = max(k for k, line in enumerate(above) if "Aggregate" in line)
    assert all(depth(line) < depth(plan[count]) for line in above if "Generate" in line) and any("Generate" in line for line in above)
    monkeypatch.setattr(hist, "TABLE_BYTES", 0)
    assert hist.group_density(table, "g.x", "v", 8, bins=16).count() == 5 * 8
    with pytest.raises(ValueError):
        hist.group_density(table, "g.x", "v", bins=1)
