"""Tables between the stages of an operator, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: Bytes up to which a table is broadcast, by ``row_bytes``; beyond it the join shuffles.
BROADCAST_BYTES = 96 << 20


class Scratch:
    """A folder below ``spark.checkpoint.dir``.  ``save`` writes a table and
    reads it back, which cuts the lineage: a lost executor costs one stage.
    ``drop`` removes a table that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.made = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def row_bytes(schema: T.StructType) -> int:
    """Bytes a row of the schema is reckoned at: 16 for the row itself, a
    value of fixed size by its size, text and bytes at 48.  A list counts as
    one element: where rows hold lists, their elements are counted as rows."""
    def one(kind: T.DataType) -> int:
        if isinstance(kind, T.StructType):
            return sum(one(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return one(kind.elementType)
        return 48 if isinstance(kind, (T.StringType, T.BinaryType, T.MapType)) else 8

    return 16 + one(schema)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose rows take at most BROADCAST_BYTES; else
    the table as it is, and Spark picks a join that shuffles."""
    return F.broadcast(df) if rows * row_bytes(df.schema) <= BROADCAST_BYTES else df
