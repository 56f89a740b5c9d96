"""Broadcasts are bounded by bytes, and joins give the same rows on both sides of the bound."""

import numpy as np
import pytest
from llm_data import documents
from pyspark.sql import functions as F

from tabprep.llm import kernels, near_dup, shared, suffix_dedup


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_bound_in_bytes(spark):
    narrow = spark.range(10).select("id", (F.col("id") * 2).alias("b"))
    wide = narrow.withColumn("s", F.lit("x")).withColumn("l", F.array(F.struct("id", "b")))
    assert shared.row_bytes(narrow.schema) == 32 and shared.row_bytes(wide.schema) == 96
    for df in (narrow, wide):
        most = shared.BROADCAST_BYTES // shared.row_bytes(df.schema)
        assert hinted(shared.sized(df, most)) and not hinted(shared.sized(df, most + 1))


@pytest.mark.parametrize("bound", [0, 1 << 40])
def test_same_rows_by_broadcast_and_by_shuffle(spark, monkeypatch, bound):
    df = documents(spark, seed=3)
    rows = lambda: (sorted((tuple(r) for r in near_dup.find_groups(df).collect()), key=str), sorted((tuple(r) for r in suffix_dedup.remove_repeats(df).collect()), key=str))
    want = rows()
    monkeypatch.setattr(shared, "BROADCAST_BYTES", bound)
    assert rows() == want


def test_workers_keep_only_their_own(monkeypatch):
    monkeypatch.setattr(kernels, "_kept", {})
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": ["some words here", None, "x" * 50]})
    made = kernels.kept("pieces", "p", lambda: [1])
    assert kernels.kept("pieces", "p", lambda: [2]) is made
    assert len(list(kernels.blocks(iter([batch]), "text", owner="pieces"))) == 1 and kernels._kept
    outer = kernels.blocks(iter([batch]), "text", 4, owner="pieces")
    next(outer)
    kernels.SpanHash(np.zeros(3, np.uint8))
    list(kernels.blocks(iter([batch]), "text"))       # inside another: frees nothing and does not tidy up
    assert kernels._kept and kernels._powers
    list(outer)
    assert not kernels._powers and kernels._open == 0
    list(kernels.blocks(iter([batch]), "text"))       # another operator's task
    assert not kernels._kept
