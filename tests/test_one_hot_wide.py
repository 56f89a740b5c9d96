"""One-hot encoding beyond the column limit: same meaning as the 0/1 columns."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import encode
from tabprep.operators.train import ModelConfig, ModelType, fit, score
from tabprep.plans import preparation


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(5)
    names = [f"v{k:03d}é" for k in range(40)]
    rows = [(i, rnd.choice(names) if rnd.random() < 0.9 else None, rnd.choice("ab"), rnd.random(), rnd.randint(0, 1)) for i in range(600)]
    return spark.createDataFrame(rows, "id long, `big.one` string, small string, x double, y int")


@pytest.mark.parametrize("drop_first", [True, False])
@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_vector_equals_the_columns(table, monkeypatch, drop_first, limit):
    monkeypatch.setattr(encode, "DICTIONARY_BYTES", limit)       # broadcast, and the join that shuffles
    columns = encode.one_hot(table, ["big.one"], drop_first=drop_first)
    names = [n for n in columns.columns if n.startswith("big.one_")]
    want = {r["id"]: [r[n] for n in names] for r in columns.collect()}
    got = {r["id"]: r["v"] for r in encode.one_hot_vector(table, "big.one", "v", drop_first=drop_first).collect()}
    assert len(names) == 40 - drop_first and set(got) == set(want)
    for i, v in got.items():
        assert v.toArray().tolist() == want[i] and len(v.indices) <= 1


def test_columns_beyond_the_limit(table):
    cats = encode.categories(table, ["big.one", "small"], max_categories=10)
    assert cats["small"] == ["a", "b"] and [r["value"] for r in cats["big.one"].orderBy("rank").collect()] == sorted({r[0] for r in table.select("`big.one`").collect()} - {None})
    out = encode.one_hot(table, ["big.one", "small"], cats=cats)
    assert out.columns == ["id", "x", "y", "big.one_vec", "small_b"]
    # a dictionary fitted on other rows: unknown categories are all zeros
    first = encode.category_index(table.where("`big.one` < 'v005'"), "big.one")
    row = encode.one_hot_vector(table.where("`big.one` >= 'v005'"), "big.one", "v", first).first()
    assert row["v"].size == 4 and len(row["v"].indices) == 0


def test_prepared_and_fitted(table, monkeypatch):
    monkeypatch.setattr(encode, "categories", lambda df, cols, m=10: _categories(df, cols, m))
    monkeypatch.setattr(preparation, "categories", lambda df, cols: _categories(df, cols, 10))
    p = preparation.prepare_data(table, "y", "id", ["big.one", "small"])
    assert p.feature_names == ("x", "big.one_vec", "small_b")
    model, _ = fit(ModelConfig(ModelType.LOGISTIC_REGRESSION, "lr"), p.train, list(p.feature_names), "y")
    assert model.numFeatures == 1 + 39 + 1
    assert score(model, p.test, list(p.feature_names), keep=["id"]).count() == p.test.count()


_categories = encode.categories


def test_no_categories(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, s string")
    assert [r["v"].size for r in encode.one_hot_vector(df, "s", "v").collect()] == [0, 0]
    assert encode.categories(df, ["s"]) == {"s": []}
    one = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    assert [r["v"].size for r in encode.one_hot_vector(one, "s", "v").collect()] == [0, 0]
    assert [r["d"] for r in encode.one_hot_index(one, "s", out="d").collect()] == [None, None]
