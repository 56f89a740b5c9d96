"""Every registered query with an oracle matches DuckDB on sf0.001 (the
driver runs the same comparison at sf0.01)."""
import os

import pytest

import __spark_entry__ as entry
from tabprep.plans.oracle_check import compare

SF = os.environ.get("TABPREP_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_all_oracles(spark):
    res = compare(spark, SF, NAMES, verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad


def test_every_query_has_a_callable_and_oracles_are_registered():
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
    assert all(callable(f) for f in qs.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "median" in df.columns
