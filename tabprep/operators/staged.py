"""Boosted models round by round: staged margins, histories, early stopping.

MLlib returns a finished ensemble; what it predicted after each round follows
from its trees.  They are read from the saved model (a Parquet table of
nodes), flattened into arrays, and a row's leaf values in all trees are found
together, one numpy step per level; their running sum is the margin after
every round -- one array column.  Exploded by round it feeds
``history.metric_history``, so a fit has the same series as any other run, and
``history.early_stop`` applies to it.

What reaches the driver is the model (trees x nodes), never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c
from ..session import ensure_checkpoint_dir
from . import history
from .train import ModelConfig, ModelType, fit

#: Series of a fit's history, each for training and (``val_``) validation rows.
SERIES = ("loss", *history.METRICS)
_CHUNK = 4096                                         # rows traversed at once
_COUNTED = 1 << 21                                    # margins counted at once


class _Saved:
    """A model saved in the shared folder for the time of a ``with`` block."""

    def __init__(self, spark: SparkSession, model: Model | None = None):
        self.spark, self.path = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
        if model is not None:
            model.write().save(self.path)

    def __enter__(self) -> str:
        return self.path

    def __exit__(self, *_) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class FlatTrees:
    """All nodes of all trees side by side; a leaf is its own child, and its
    value holds the tree's weight."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row (rows x features) after each round (rows x trees)."""
        out = np.empty((len(x), len(self.roots)))
        for k in range(0, len(x), _CHUNK):
            own = x[k:k + _CHUNK]
            at, row = np.repeat(self.roots[None, :], len(own), 0), np.arange(len(own))[:, None]
            for _ in range(self.depth):
                at = np.where(own[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            np.cumsum(self.value[at], axis=1, out=out[k:k + _CHUNK])
        return out


def flatten(model: Model, spark: SparkSession) -> FlatTrees:
    with _Saved(spark, model) as path:
        node = "nodeData"
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID", f"{node}.id", f"{node}.prediction", f"{node}.leftChild", f"{node}.rightChild", f"{node}.split.featureIndex",
            f"{node}.split.leftCategoriesOrThreshold", f"{node}.split.numCategories").orderBy("treeID", "id").collect()
        weights = [float(w) for w in model.treeWeights]
    n = len(nodes)
    feature, threshold, value = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
    left, right, level = np.arange(n), np.arange(n), np.zeros(n, np.int64)
    first: dict[int, int] = {}
    for k, r in enumerate(nodes):
        start = first.setdefault(r.treeID, k)
        value[k] = r.prediction * weights[r.treeID]
        if r.leftChild >= 0:
            if r.numCategories >= 0:
                raise ValueError("splits by category are not supported: encode categories as numbers or flags")
            feature[k], threshold[k] = r.featureIndex, r.leftCategoriesOrThreshold[0]
            left[k], right[k] = start + r.leftChild, start + r.rightChild
            level[[left[k], right[k]]] = level[k] + 1     # a node comes before its children
    return FlatTrees(feature, threshold, left, right, value, np.array([first[t] for t in sorted(first)]), int(level.max(initial=0)))


def staged_margins(model: Model, df: DataFrame, feature_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns and ``margins``: the ensemble's margin after each round."""
    trees = df.sparkSession.sparkContext.broadcast(flatten(model, df.sparkSession))   # bounded by the model

    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        return pd.Series(list(trees.value.margins(np.stack(x.to_list())))) if len(x) else pd.Series([], dtype=object)

    return df.select(*[c(k) for k in keep], margins(F.array(*[c(f).cast("double") for f in feature_cols])).alias("margins"))


def by_round(staged: DataFrame) -> DataFrame:
    """One row per row and round: ``round`` from 1, ``margin``, ``probability``
    (for boosting on the log loss: 1 / (1 + exp(-2 margin)))."""
    kept = [c(n) for n in staged.columns if n != "margins"]
    rows = staged.select(*kept, F.posexplode("margins").alias("__k", "margin"))
    return rows.select(*kept, (F.col("__k") + 1).alias("round"), "margin", (1 / (1 + F.exp(F.col("margin") * -2))).alias("probability"))


def staged_counts(model: Model, df: DataFrame, feature_cols: Sequence[str], label_col: str, val_col: str) -> DataFrame:
    """(``__val``, round, margin, ``__pos``, ``__neg``): positive and negative
    rows by the margin they have after each round.  Rows are counted in their
    task, _COUNTED margins at a time; a margin may have several rows here."""
    trees = df.sparkSession.sparkContext.broadcast(flatten(model, df.sparkSession))   # bounded by the model
    is_label = lambda v: F.coalesce((c(label_col) == v).cast("long"), F.lit(0).cast("long"))
    rows = df.select(c(val_col).alias("__val"), is_label(1).alias("__pos"), is_label(0).alias("__neg"), F.array(*[c(f).cast("double") for f in feature_cols]).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        most = max(1, _COUNTED // max(len(trees.value.roots), 1))

        def counted() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            val, pos, neg = (table.column(k).to_numpy() for k in range(3))
            x = table.column(3).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(val), -1)
            margins = trees.value.margins(x)
            for side in (False, True):
                own = np.flatnonzero(val == side)
                for k in range(margins.shape[1] if len(own) else 0):
                    margin, at = np.unique(margins[own, k], return_inverse=True)
                    per = [np.bincount(at, weights=n[own], minlength=len(margin)).astype(np.int64) for n in (pos, neg)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(margin), side)), pa.array(np.full(len(margin), k + 1, np.int32)), pa.array(margin), *map(pa.array, per)],
                                                     names=["__val", "round", "margin", "__pos", "__neg"])

        for batch in batches:
            for k in range(0, batch.num_rows, most):
                held.append(batch.slice(k, most))
                if sum(b.num_rows for b in held) >= most:
                    yield from counted()
        if held:
            yield from counted()

    return rows.mapInArrow(run, "__val boolean, round int, margin double, __pos bigint, __neg bigint")


def fit_history(model: Model, train: DataFrame, val: DataFrame, feature_cols: Sequence[str], label_col: str,
                metrics: Sequence[str] = SERIES, threshold: float = 0.5) -> DataFrame:
    """(round, metric, value) of a boosted fit: the series of ``metrics`` on
    the training rows and, as ``val_<metric>``, on the validation rows."""
    wanted = [*feature_cols, label_col]
    rows = [d.select(*[c(n) for n in dict.fromkeys(wanted)]).withColumn("__is_val", F.lit(v)) for d, v in ((train, False), (val, True))]
    counted = staged_counts(model, rows[0].unionByName(rows[1]), feature_cols, label_col, "__is_val")
    scored = counted.select("round", "__val", (1 / (1 + F.exp(F.col("margin") * -2))).alias("__s"), "__pos", "__neg")
    counts = scored.groupBy("round", "__val", "__s").agg(F.sum("__pos").alias("__pos"), F.sum("__neg").alias("__neg"))
    return history.history_of_counts(counts, ["round"], metrics, threshold)


def truncated(model: Model, rounds: int, spark: SparkSession) -> GBTClassificationModel:
    """The ensemble of the first ``rounds`` rounds, an MLlib model like any other."""
    if not 1 <= rounds <= model.getNumTrees:
        raise ValueError(f"rounds must be 1 to {model.getNumTrees}")
    with _Saved(spark, model) as path, _Saved(spark) as to:
        for part in ("data", "treesMetadata"):
            table = spark.read.parquet(f"{path}/{part}")
            table.where(F.col(table.columns[0]) < rounds).coalesce(1).write.parquet(f"{to}/{part}")
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        meta["numTrees"] = rounds
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{to}/metadata")
        return GBTClassificationModel.load(to)


@dataclass(frozen=True)
class StoppedFit:
    model: GBTClassificationModel      # of the best round, or of all rounds until the stop
    history: DataFrame                 # (round, metric, value) until the stop
    best_round: int
    best_value: float
    stop_round: int
    stopped: bool
    seconds: float


def fit_until(config: ModelConfig, train: DataFrame, val: DataFrame, feature_cols: Sequence[str], label_col: str, *,
              monitor: str = "val_f1", mode: str = "max", patience: int = 5, min_delta: float = 0.0,
              restore_best_weights: bool = True, threshold: float = 0.5) -> StoppedFit:
    """Boosting stopped by any monitored series.

    A round of boosting never changes earlier trees, so stopping early equals
    cutting the full ensemble: all rounds are fitted, the series come from
    staged margins, and the model is cut at the best round
    (``restore_best_weights``) or where patience ended.  A series that never
    has a value (no predicted positives in any round) is an error."""
    if config.model_type not in (ModelType.XGBOOST, ModelType.GRADIENT_BOOSTING):
        raise ValueError("early stopping is available for the boosting models")
    history.monitor_mode(monitor, mode)
    spark = train.sparkSession
    model, seconds = fit(config, train, feature_cols, label_col)
    series = fit_history(model, train, val, feature_cols, label_col, threshold=threshold)
    rows = series.collect()                           # rounds x series
    series = spark.createDataFrame(rows, series.schema)
    found = history.early_stop(series, monitor, mode, patience, min_delta).first()
    if found is None or found["best_round"] is None:
        raise ValueError(f"{monitor} has no value in any round")
    best, stop = int(found["best_round"]), int(found["stop_round"])
    return StoppedFit(truncated(model, best if restore_best_weights else stop, spark), series.where(F.col("round") <= stop),
                      best, float(found["best_value"]), stop, bool(found["stopped"]), seconds)
