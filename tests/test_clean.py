import math

import pytest
from pyspark.sql import functions as F

from tabprep.operators.clean import (CaseStyle, FillStrategy, clean_dataframe, clean_numeric_columns,
                                     clean_object_columns)
from tabprep.functions.text import DEFAULT_MISSING_VALUES


@pytest.fixture
def objects(spark):
    return spark.createDataFrame(
        [(0, "John", "new york"), (1, "NA", "N/A"), (2, "Jane", "BOSTON"), (3, "?", "null"),
         (4, "Bob", "  chicago  ")], "id int, name string, city string")


@pytest.fixture
def numbers(spark):
    return spark.createDataFrame(
        [(0, 25.0, 50000.0), (1, None, 60000.0), (2, 35.0, None), (3, 40.0, 80000.0), (4, None, 90000.0)],
        "id int, age double, salary double")


def col(df, name):
    return [r[0] for r in df.orderBy("id").select(name).collect()]


def test_placeholders_become_null(objects):
    out = clean_object_columns(objects)
    assert col(out, "name") == ["John", None, "Jane", None, "Bob"]
    assert col(out, "city") == ["new york", None, "BOSTON", None, "chicago"]


def test_custom_replacement_and_case_after_replacement(objects):
    out = clean_object_columns(objects, replacement="missing", case_style=CaseStyle.UPPER)
    assert col(out, "name") == ["JOHN", "MISSING", "JANE", "MISSING", "BOB"]


def test_title_upper_lower_original(objects):
    assert col(clean_object_columns(objects, case_style=CaseStyle.TITLE), "city")[0] == "New York"
    assert col(clean_object_columns(objects, case_style=CaseStyle.TITLE), "city")[2] == "Boston"
    assert col(clean_object_columns(objects, case_style=CaseStyle.LOWER), "city")[2] == "boston"
    assert col(clean_object_columns(objects, case_style=CaseStyle.ORIGINAL), "city")[2] == "BOSTON"


def test_title_case_matches_python_rules(spark):
    # (letters whose title case differs from their upper case, such as ß, are
    # upper-cased: a documented difference)
    words = ["o'neil mc-donald 3rd", "hello   WORLD", "élan VITAL", "ab1cd", "", "x"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, w string")
    out = col(clean_object_columns(df, ["w"], missing_values=(), case_style=CaseStyle.TITLE), "w")
    assert out == [w.title() for w in words]


def test_no_strip_keeps_padding_and_nulls(spark):
    df = spark.createDataFrame([(0, "  chicago  "), (1, None), (2, " ")], "id int, c string")
    out = clean_object_columns(df, strip_whitespace=False, replacement="X")
    assert col(out, "c") == ["  chicago  ", None, "X"]


def test_strip_removes_unicode_whitespace(spark):
    df = spark.createDataFrame([(0, "\t a b \n"), (1, " x ")], "id int, c string")
    assert col(clean_object_columns(df), "c") == ["a b", "x"]


def test_null_gets_replacement_when_stripping(spark):
    df = spark.createDataFrame([(0, None), (1, "ok")], "id int, c string")
    assert col(clean_object_columns(df, replacement="missing"), "c") == ["missing", "ok"]


@pytest.mark.parametrize("token", DEFAULT_MISSING_VALUES)
def test_every_token(spark, token):
    df = spark.createDataFrame([(0, "valid"), (1, token), (2, "also_valid")], "id int, col string")
    assert col(clean_object_columns(df), "col") == ["valid", None, "also_valid"]


def test_matching_is_case_sensitive(spark):
    df = spark.createDataFrame([(0, "Unknown"), (1, "unknown")], "id int, c string")
    assert col(clean_object_columns(df), "c") == ["Unknown", None]


def test_specific_columns_and_unknown_names_ignored(objects):
    out = clean_object_columns(objects, columns=["name", "nope", "id"], case_style=CaseStyle.UPPER)
    assert col(out, "name")[0] == "JOHN" and col(out, "city")[0] == "new york"


def test_normalize_spaces_and_per_column_case(spark):
    df = spark.createDataFrame([(0, "john    doe", "new   york", "ABC")], "id int, name string, state string, code string")
    out = clean_object_columns(df, normalize_spaces=True, case_style=CaseStyle.LOWER,
                               column_case_styles={"name": CaseStyle.TITLE, "state": CaseStyle.UPPER})
    assert out.select("name", "state", "code").first() == ("John Doe", "NEW YORK", "abc")


def test_empty_and_no_string_columns(spark):
    empty = spark.createDataFrame([], "name string")
    assert clean_object_columns(empty).count() == 0
    nums = spark.createDataFrame([(1,), (2,), (3,)], "age int")
    assert clean_object_columns(nums).collect() == nums.collect()


def test_fill_strategies(numbers):
    assert col(clean_numeric_columns(numbers, strategy=FillStrategy.NONE), "age")[1] is None
    dropped = clean_numeric_columns(numbers, strategy=FillStrategy.DROP)
    assert dropped.count() == 2
    mean = clean_numeric_columns(numbers, strategy=FillStrategy.MEAN)
    assert col(mean, "age")[1] == pytest.approx((25 + 35 + 40) / 3)
    assert col(mean, "salary")[2] == pytest.approx(70000.0)
    med = clean_numeric_columns(numbers, strategy=FillStrategy.MEDIAN)
    assert col(med, "age")[1] == 35.0 and col(med, "salary")[2] == 70000.0
    assert col(clean_numeric_columns(numbers, strategy=FillStrategy.ZERO), "age")[4] == 0.0
    v = clean_numeric_columns(numbers, strategy=FillStrategy.VALUE, fill_value=-999.0)
    assert col(v, "salary")[2] == -999.0
    only_age = clean_numeric_columns(numbers, ["age"], FillStrategy.ZERO)
    assert col(only_age, "age")[1] == 0.0 and col(only_age, "salary")[2] is None


def test_mode_is_smallest_most_frequent(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0), (3, None), (4, 3.0), (5, 3.0)], "id int, value double")
    assert col(clean_numeric_columns(df, strategy=FillStrategy.MODE), "value")[3] == 2.0


def test_value_without_fill_value_raises(numbers):
    with pytest.raises(ValueError, match="fill_value must be provided"):
        clean_numeric_columns(numbers, strategy=FillStrategy.VALUE)


def test_all_null_column_left_alone(spark):
    df = spark.createDataFrame([(0, None), (1, None)], "id int, v double")
    assert col(clean_numeric_columns(df, strategy=FillStrategy.MEAN), "v") == [None, None]


def test_clean_dataframe_configs(spark):
    df = spark.createDataFrame([(0, "John", 25.0, "new york"), (1, "NA", None, "null"), (2, "Jane", 35.0, "BOSTON")],
                               "id int, name string, age double, city string")
    both = clean_dataframe(df, {"case_style": CaseStyle.UPPER}, {"strategy": FillStrategy.ZERO})
    assert col(both, "name")[0] == "JOHN" and col(both, "city")[0] == "NEW YORK" and col(both, "age")[1] == 0.0
    assert col(clean_dataframe(df, {"case_style": CaseStyle.UPPER}, None), "age")[1] is None
    assert col(clean_dataframe(df, None, {"strategy": FillStrategy.ZERO}), "city")[0] == "new york"
    assert clean_dataframe(df).collect() == df.collect()


def test_streaming_safe_projection(spark):
    """The text cleaner is row-local: it runs on a streaming DataFrame."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(
        F.lit(" NA ").alias("c"))
    out = clean_object_columns(stream)
    assert out.isStreaming
