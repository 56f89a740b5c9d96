"""CSV files with many spellings of missing, mixed types and malformed rows."""
import datetime
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabprep.functions.text import DEFAULT_MISSING_VALUES
from tabprep.sources.tables import csv_scan


def written(text):
    path = os.path.join(tempfile.mkdtemp(prefix="tabprep-csv-", dir="/tmp"), "t.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_tokens_go_before_types(spark):
    path = written("id,n.x,rate,flag,day,at,name,all\n"
                   "1, 7 ,0.5,true,2024-01-02,2024-01-02 03:04:05,\"a, \"\"b\"\"\",NA\n"
                   "2,N/A,?,FALSE,-,2024-01-02T03:04,  unknown ,null\n"
                   "3,unknown,1e3,none,2024-02-30x,NULL, x ,\n".replace("2024-02-30x", "2024-02-28"))
    df = csv_scan(spark, path, null_tokens=DEFAULT_MISSING_VALUES)
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "bigint", "double", "boolean", "date", "timestamp", "string", "string"]
    rows = [tuple(r) for r in df.orderBy("id").collect()]
    assert rows[0] == (1, 7, 0.5, True, datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3, 4, 5), 'a, "b"', None)
    assert rows[1][1:3] == (None, None) and rows[1][3] is False and rows[1][4] is None and rows[1][6] is None
    assert rows[2][2] == 1000.0 and rows[2][6] == " x " and rows[2][5] is None
    # without tokens one placeholder makes a number column text
    assert dict(csv_scan(spark, path).dtypes)["n.x"] == "string"


@pytest.mark.parametrize("value,kind", [("99999999999999999999", "double"), ("2024-13-01", "string"), ("1.5.2", "string"), ("0x1F", "string"), ("-Infinity", "double"), ("+5", "bigint"), ("T", "string")])
def test_types_of_odd_values(spark, value, kind):
    df = csv_scan(spark, written(f"a,b\n{value},1\n"), null_tokens=["NA"])
    assert dict(df.dtypes)["a"] == kind and df.first()["b"] == 1


def test_malformed_rows_are_kept_and_named(spark):
    path = written("a,b,c\n1,2,3\n4,5\n6,7,8,9\n,,\n")
    df = csv_scan(spark, path, null_tokens=["", "NA"], malformed="bad")
    rows = {r["a"]: r for r in df.collect()}
    assert rows[1]["bad"] is None and rows[None]["bad"] is None
    assert rows[4]["bad"] == "4,5" and (rows[4]["b"], rows[4]["c"]) == (5, None)
    assert rows[6]["bad"] == "6,7,8,9" and rows[6]["c"] == 8
    assert df.where("bad is not null").select("bad").count() == 2 and df.select("a").count() == 4
    with pytest.raises(ValueError, match="column 'c'"):
        csv_scan(spark, path, malformed="c")


def test_given_schema_and_line_breaks(spark):
    path = written('a,b\n1,"x\ny"\nbad,"NA"\n2.5,z\n')
    df = csv_scan(spark, path, schema="a int, b string", null_tokens=["NA"], multi_line=True)
    assert [tuple(r) for r in df.orderBy(F.col("b").asc_nulls_last()).collect()] == [(1, "x\ny"), (None, "z"), (None, None)]
    assert csv_scan(spark, written("a,b\n"), null_tokens=["NA"]).collect() == []
