"""Readers.  Parquet for the driver tables; CSV for user files.

Both are lazy scans, so Catalyst pushes filters and column pruning into
them.  Spark's CSV reader has a single ``nullValue``, and one placeholder such
as ``N/A`` among numbers makes the whole column text; ``csv_scan`` with
``null_tokens`` reads text, makes NULL of every spelling, and infers types from
what is left.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import c, nan_to_null
from ..functions.text import is_missing_token, strip
from ..session import save_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; NaN in float columns becomes NULL, as in ``csv_scan``."""
    return nan_to_null(spark.read.parquet(table_path(sf_dir, name)))


#: Types a text column may turn out to have, narrowest first, and what its values look like.
_SHAPES = (("boolean", r"(?i)^(true|false)$"), ("bigint", r"^[+-]?\d{1,18}$"),
           ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(NaN|Infinity)$"),
           ("date", r"^\d{4}-\d{2}-\d{2}$"), ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"))


def inferred_types(text: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type that every non-NULL value of each text column can be
    cast to (one aggregate over all columns); columns without values are text."""
    fits = lambda n, kind, shape: strip(c(n)).rlike(shape) & strip(c(n)).try_cast(kind).isNotNull()
    if not columns:
        return {}
    row = text.agg(*[F.count(c(n)).alias(f"n{i}") for i, n in enumerate(columns)],
                   *[F.count_if(fits(n, kind, shape)).alias(f"{kind}{i}") for i, n in enumerate(columns) for kind, shape in _SHAPES]).first()
    return {n: next((kind for kind, _ in _SHAPES if row[f"n{i}"] and row[f"{kind}{i}"] == row[f"n{i}"]), "string") for i, n in enumerate(columns)}


def csv_scan(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, null_value: str = "", null_tokens: Sequence[str] | None = None,
             malformed: str | None = None, multi_line: bool = False) -> DataFrame:
    """Load a CSV file (or folder of files).

    Pass ``schema`` in production: inference reads the data twice.  NaN read
    into float columns becomes NULL so there is one missing value.

    ``null_tokens``: values that equal one of them after stripping become NULL
    before types are inferred; a value that does not fit a given ``schema``
    becomes NULL.  ``malformed`` names an added column with the raw text of
    rows that have too few or too many values (NULL in the others; what was
    read of such a row is kept); the text is then written once to the shared
    folder.  ``multi_line``: values may hold line breaks
    (then a file is one task).  Quotes inside values are doubled.
    """
    reader = spark.read.option("header", header)
    if null_tokens is None and malformed is None:
        reader = reader.option("nullValue", null_value)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return nan_to_null(reader.csv(path))
    reader = reader.option("multiLine", multi_line).option("escape", '"')
    wanted = (spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema) if schema is not None else None
    names = wanted.fieldNames() if wanted is not None else reader.csv(path).columns       # the first line of one file
    if malformed in names:
        raise ValueError(f"the file has a column {malformed!r}")
    fields = [StructField(n, StringType()) for n in [*names, *([malformed] if malformed else [])]]
    if malformed:      # a pruned scan would not see that values are missing
        reader = reader.option("columnNameOfCorruptRecord", malformed).option("columnPruning", "false")
    text = reader.option("mode", "PERMISSIVE").schema(StructType(fields)).csv(path)
    if malformed:      # Spark refuses queries of this column alone on the file itself
        text = save_table(text, "csv")
    tokens = list(null_tokens) if null_tokens is not None else [null_value]
    text = text.select(*[F.when(~is_missing_token(strip(c(n)), tokens) & ~is_missing_token(c(n), tokens), c(n)).alias(n) for n in names], *([c(malformed)] if malformed else []))
    kinds = {f.name: f.dataType.simpleString() for f in wanted.fields} if wanted is not None else inferred_types(text, names)

    def typed(n: str) -> Column:
        return c(n) if kinds[n] == "string" else strip(c(n)).try_cast(kinds[n])

    return nan_to_null(text.select(*[typed(n).alias(n) for n in names], *([c(malformed)] if malformed else [])))
