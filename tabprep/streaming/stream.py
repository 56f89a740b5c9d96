"""Structured Streaming use of the library.

Nothing in the reference is stateful; what carries over to streams is the
row-local half of every operator.  Statistics (fill values, categories,
scaler, class weights) are fitted on a batch table once; ``apply`` then runs
on a streaming DataFrame with no action.  The one stateful piece is the
running confusion count: TP/FP/FN/TN are sums, so accuracy, precision,
recall and F1 of everything seen so far are a streaming aggregation
(complete output mode) plus a projection.

Checkpoint locations always live under the session's ``spark.checkpoint.dir``
(the cluster's shared folder), never on a machine-local path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import c, numeric_columns
from ..operators.clean import FillStrategy, apply_fills, clean_object_columns, numeric_fill_values
from ..operators.encode import categories, one_hot
from ..operators.metrics import _rates, predict
from ..operators.scale import ScalerModel, fit_standard_scaler
from ..session import ensure_checkpoint_dir
from ..sources.tables import table_path


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table as a file stream (new files appearing next to it are
    picked up by later triggers)."""
    path = table_path(sf_dir, name)
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("basePath", sf_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a file stream source takes a folder or a glob; the bracket glob picks one table
    return reader.parquet(path[:-1] + "[" + path[-1] + "]")


@dataclass(frozen=True)
class FittedPreparation:
    """Everything ``apply`` needs, fitted on a batch table."""
    object_config: Mapping = field(default_factory=dict)
    fills: Mapping = field(default_factory=dict)
    fill_as_double: bool = False
    categories: Mapping = field(default_factory=dict)
    target_col: str | None = None
    scaler: ScalerModel | None = None
    drop_missing: Sequence[str] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        """Row-local: valid on batch and streaming DataFrames alike."""
        out = clean_object_columns(df, **self.object_config) if self.object_config is not None else df
        if self.drop_missing:
            out = out.na.drop("any", subset=list(self.drop_missing))
        if self.fills:
            out = apply_fills(out, self.fills, self.fill_as_double)
        if self.categories:
            out = one_hot(out, list(self.categories), self.target_col, cats=dict(self.categories))
        if self.scaler is not None:
            out = self.scaler.transform(out)
        return out


def fit_preparation(batch: DataFrame, object_config: Mapping | None = None,
                    fill_strategy: FillStrategy = FillStrategy.NONE, fill_columns: Sequence[str] | None = None,
                    categorical_cols: Sequence[str] = (), target_col: str | None = None,
                    scale_columns: Sequence[str] | None = None, fill_value: float | None = None) -> FittedPreparation:
    """Fit on a batch table.  VALUE fills with ``fill_value``; DROP removes
    rows with a missing value in the fill columns."""
    if fill_strategy == FillStrategy.VALUE and fill_value is None:
        raise ValueError("fill_value must be provided when using FillStrategy.VALUE")
    cleaned = clean_object_columns(batch, **(object_config or {}))
    fills = {}
    if fill_strategy in (FillStrategy.MEAN, FillStrategy.MEDIAN, FillStrategy.MODE):
        fills = numeric_fill_values(cleaned, numeric_columns(cleaned, fill_columns), fill_strategy)
    elif fill_strategy == FillStrategy.ZERO:
        fills = {n: 0 for n in numeric_columns(cleaned, fill_columns)}
    elif fill_strategy == FillStrategy.VALUE:
        fills = {n: fill_value for n in numeric_columns(cleaned, fill_columns)}
    drop_missing = tuple(numeric_columns(cleaned, fill_columns)) if fill_strategy == FillStrategy.DROP else ()
    cats = categories(cleaned, list(categorical_cols)) if categorical_cols else {}
    scaler = None
    if scale_columns:
        scaler = fit_standard_scaler(apply_fills(cleaned, fills), scale_columns)
    return FittedPreparation(dict(object_config or {}), fills,
                             fill_strategy in (FillStrategy.MEAN, FillStrategy.MEDIAN), cats, target_col, scaler, drop_missing)


def confusion_counts(scored: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
                     ) -> DataFrame:
    """Running TN/FP/FN/TP with accuracy, precision, recall and F1 (a global
    streaming aggregation: the state is four longs)."""
    y, p = c(label_col), c(prediction_col)
    k = scored.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))
    return k.select("tn", "fp", "fn", "tp", *_rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def score_stream(stream: DataFrame, score_col: str, threshold: float = 0.5,
                 prediction_col: str = "prediction") -> DataFrame:
    return stream.withColumn(prediction_col, predict(c(score_col), threshold))


def run_available(df: DataFrame, output_mode: str = "append", name: str | None = None,
                  timeout_s: float = 600) -> DataFrame:
    """Process everything available now (``availableNow`` trigger) and return
    it as a batch DataFrame.  Appended rows go to a Parquet folder in the
    shared folder; complete mode (an aggregate that is rewritten as a whole,
    one row for the running metrics) goes to an in-memory table."""
    spark = df.sparkSession
    name = name or f"tabprep_{uuid.uuid4().hex[:12]}"
    root = os.path.join(ensure_checkpoint_dir(spark), "streams", name)
    to_files = output_mode == "append"
    writer = df.writeStream.format("parquet" if to_files else "memory").queryName(name).outputMode(output_mode)
    if to_files:
        writer = writer.option("path", f"{root}/rows")
    q = writer.option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(df.schema).parquet(f"{root}/rows") if to_files else spark.table(name)
