"""Model building, weighted fitting and scoring.

Models are MLlib estimators (the network: ``network``), so every fit is
distributed.  A prepared table
(key, features..., label, split) is turned into a vector column once; class
weights are a ``weightCol`` built from a literal class -> weight map.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from enum import Enum
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import UserDefinedType

from ..functions.columns import c
from . import hist_trees
from .imbalance import class_weight_dict
from .network import NetworkClassifier

FEATURES = "features"
#: Beyond so many rows trees are grown by ``hist_trees``.
LARGE_ROWS = 250_000


class ModelType(Enum):
    NEURAL_NETWORK = "neural_network"
    RANDOM_FOREST = "random_forest"
    XGBOOST = "xgboost"
    LOGISTIC_REGRESSION = "logistic_regression"
    GRADIENT_BOOSTING = "gradient_boosting"


# Default hyper-parameters per model type.
DEFAULT_PARAMS = {
    ModelType.NEURAL_NETWORK: {"layers": [32, 16], "dropout_rate": 0.3, "learning_rate": 0.001, "epochs": 50},
    ModelType.RANDOM_FOREST: {"n_estimators": 100, "max_depth": 10, "min_samples_split": 50,
                              "min_samples_leaf": 20, "random_state": 42},
    ModelType.XGBOOST: {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "random_state": 42},
    ModelType.LOGISTIC_REGRESSION: {"max_iter": 1000, "random_state": 42},
    ModelType.GRADIENT_BOOSTING: {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1, "random_state": 42},
}


# What each model takes; another name is an error, so that no setting is ignored.
KNOWN_PARAMS = {
    ModelType.NEURAL_NETWORK: {"layers", "dropout_rate", "learning_rate", "epochs", "batch_size", "random_state"},
    ModelType.RANDOM_FOREST: {"n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "random_state", "max_memory_mb"},
    ModelType.XGBOOST: {"n_estimators", "max_depth", "learning_rate", "random_state"},
    ModelType.LOGISTIC_REGRESSION: {"max_iter", "C", "tol", "random_state"},
    ModelType.GRADIENT_BOOSTING: {"n_estimators", "max_depth", "learning_rate", "random_state"},
}


@dataclass
class ModelConfig:
    model_type: ModelType
    name: str
    params: dict = field(default_factory=dict)
    class_weight: str | Mapping | None = None

    def __post_init__(self):
        if not self.params:
            self.params = dict(DEFAULT_PARAMS.get(self.model_type, {}))


def default_configs(use_neural_network=True, use_random_forest=True, use_xgboost=True, use_logistic=False,
                    use_gradient_boosting=False, class_weight="balanced") -> list[ModelConfig]:
    out = []
    for use, t, name in ((use_neural_network, ModelType.NEURAL_NETWORK, "Neural Network"),
                         (use_random_forest, ModelType.RANDOM_FOREST, "Random Forest"),
                         (use_xgboost, ModelType.XGBOOST, "XGBoost"),
                         (use_logistic, ModelType.LOGISTIC_REGRESSION, "Logistic Regression"),
                         (use_gradient_boosting, ModelType.GRADIENT_BOOSTING, "Gradient Boosting")):
        if use:
            out.append(ModelConfig(t, name, class_weight=class_weight))
    return out


def assemble(df: DataFrame, feature_cols: Sequence[str], out_col: str = FEATURES) -> DataFrame:
    """Features as one vector column (NULL features are an error: clean or
    fill them first).  Vector columns, as of wide one-hot encodings, go in whole."""
    vector = lambda f: isinstance(df.schema[f].dataType, VectorUDT)
    quoted = df.select("*", *[(c(f) if vector(f) else c(f).cast("double")).alias(f"__f{i}") for i, f in enumerate(feature_cols)])
    va = VectorAssembler(inputCols=[f"__f{i}" for i in range(len(feature_cols))], outputCol=out_col)
    return va.transform(quoted).drop(*[f"__f{i}" for i in range(len(feature_cols))])


def build_model(config: ModelConfig, n_features: int, label_col: str = "label",
                weight_col: str | None = None, n_train: float | None = None) -> Estimator:
    """Estimator for a config; a setting it cannot honour is an error.

    Random forest: ``minInstancesPerNode`` = min_samples_leaf.  MLlib has no
    least size of a node to split; a split needs two leaves, so a
    ``min_samples_split`` up to twice the leaf size (and the default 50) holds
    by it, a larger one is refused.  XGBoost and gradient boosting: ``GBTClassifier`` (class
    weights are ignored for gradient boosting, like the reference).
    Logistic regression: L2 with C = 1 is ``regParam = 1 / n`` without
    standardisation (MLlib averages the loss where C multiplies its sum);
    tolerance 1e-4 as in the usual library default (MLlib's is 1e-6).
    Neural network: ``network.NetworkClassifier`` (row weights, dropout and
    learning rate count).
    """
    p = config.params
    t = config.model_type
    unknown = set(p) - KNOWN_PARAMS.get(t, set(p))
    if unknown:
        raise ValueError(f"{t.value} does not take {', '.join(sorted(unknown))}; it takes {', '.join(sorted(KNOWN_PARAMS[t]))}")
    common = {"featuresCol": FEATURES, "labelCol": label_col}
    if t == ModelType.RANDOM_FOREST:
        least = int(p.get("min_samples_split", 2))
        if least > 2 * int(p.get("min_samples_leaf", 1)) and least != DEFAULT_PARAMS[t]["min_samples_split"]:
            raise ValueError("min_samples_split beyond twice min_samples_leaf is not supported: set min_samples_leaf")
        est = RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 10)),
                                     minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                     seed=int(p.get("random_state", 42)),
                                     # more nodes split per pass over the data, and the
                                     # row -> node map cached instead of re-derived
                                     maxMemoryInMB=int(p.get("max_memory_mb", 1024)), cacheNodeIds=True,
                                     **common)
    elif t in (ModelType.XGBOOST, ModelType.GRADIENT_BOOSTING):
        est = GBTClassifier(maxIter=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 5)),
                            stepSize=float(p.get("learning_rate", 0.1)), seed=int(p.get("random_state", 42)),
                            **common)
    elif t == ModelType.LOGISTIC_REGRESSION:
        c_inv = 1.0 / float(p.get("C", 1.0))
        est = LogisticRegression(maxIter=int(p.get("max_iter", 100)), regParam=c_inv / max(n_train or 1.0, 1.0),
                                 elasticNetParam=0.0, standardization=False, tol=float(p.get("tol", 1e-4)),
                                 **common)
    elif t == ModelType.NEURAL_NETWORK:
        est = NetworkClassifier(tuple(int(h) for h in p.get("layers", [32, 16])), int(p.get("epochs", 50)), float(p.get("learning_rate", 0.001)),
                                float(p.get("dropout_rate", 0.0)), p.get("batch_size", 256), int(p.get("random_state", 42)), FEATURES, label_col)
    else:
        raise ValueError(f"Unknown model type: {t}")
    if weight_col and t != ModelType.GRADIENT_BOOSTING:
        est.setWeightCol(weight_col)
    return est


def weight_column(df: DataFrame, label_col: str, weights: Mapping | None, weight_col: str = "weight"
                  ) -> DataFrame:
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn(weight_col, F.coalesce(m[c(label_col)], F.lit(1.0)))


def fit(config: ModelConfig, train: DataFrame, feature_cols: Sequence[str], label_col: str,
        class_weights: Mapping | str | None = None, scale_pos_weight: float | None = None
        ) -> tuple[Model, float]:
    """Fit on ``train`` (features assembled here); returns (model, seconds).

    ``class_weights="balanced"`` computes n / (k n_c) from the labels.
    For XGBoost ``scale_pos_weight`` multiplies the positive rows' weight.
    """
    # MLlib resolves column names as paths: give the label a plain name
    data = assemble(train, feature_cols).withColumn("__label", c(label_col).cast("double"))
    weights = None
    if class_weights == "balanced":
        weights = class_weight_dict(train, label_col)
    elif isinstance(class_weights, Mapping):
        weights = dict(class_weights)
    if config.model_type == ModelType.XGBOOST and scale_pos_weight:
        weights = {0: 1.0, 1: float(scale_pos_weight)}
    wcol = None
    if weights and config.model_type != ModelType.GRADIENT_BOOSTING:
        data = weight_column(data, label_col, weights)
        wcol = "weight"
    n_train = data.agg(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0] \
        if config.model_type == ModelType.LOGISTIC_REGRESSION else None
    est = build_model(config, len(feature_cols), "__label", wcol, n_train)
    t0 = time.time()
    model = _fit_large(est, data, wcol, feature_cols) or est.fit(data)
    return model, time.time() - t0


def _fit_large(est: Estimator, data: DataFrame, weight_col: str | None, feature_cols: Sequence[str]) -> Model | None:
    """The trees of a large table of two classes, grown from histograms; None
    for other tables and models."""
    if not hist_trees.fits(est) or any(isinstance(data.schema[f].dataType, VectorUDT) for f in feature_cols):
        return None
    y, w = F.col("__label"), F.col(weight_col) if weight_col else F.lit(1.0)
    n, known, *weights = data.agg(F.count(F.lit(1)), F.count_if(y.isin(0.0, 1.0)), *[agg(F.when(y == k, w)) for k in (0, 1) for agg in (F.min, F.max)]).first()
    if n <= LARGE_ROWS or known < n or any(x is None or x <= 0 for x in weights) or weights[0] != weights[1] or weights[2] != weights[3]:
        return None
    return hist_trees.fit(est, data, n, weights[::2])


def score(model: Model, df: DataFrame, feature_cols: Sequence[str], threshold: float = 0.5,
          keep: Sequence[str] = ()) -> DataFrame:
    """Positive-class probability and the class at ``threshold`` (>=) for
    every row; row-local, so it also runs on a streaming DataFrame."""
    grown = getattr(model, "grown", None)
    if grown is not None and not any(isinstance(df.schema[k].dataType, UserDefinedType) for k in keep):
        out = hist_trees.scored(grown, assemble(df, feature_cols), FEATURES, keep)
        proba = F.col("probability")
    else:
        out = model.transform(assemble(df, feature_cols))
        proba = vector_to_array(F.col("probability"))[1]
    return out.select(*[c(k) for k in keep], proba.alias("probability"),
                      (proba >= F.lit(float(threshold))).cast("int").alias("prediction"))


def feature_importance(model: Any, feature_cols: Sequence[str], spark) -> DataFrame | None:
    """(feature, importance) descending, for models that expose it."""
    imp = getattr(model, "featureImportances", None)
    if imp is None:
        return None
    vals = imp.toArray().tolist()
    rows = sorted(zip(feature_cols, vals), key=lambda r: (-r[1], r[0]))
    # one row per feature (schema-bounded)
    return spark.createDataFrame(rows, "feature string, importance double")


def boosting_history(model: Any, train: DataFrame, val: DataFrame, feature_cols: Sequence[str],
                     label_col: str, spark) -> DataFrame:
    """Loss after each boosting round on train and validation (the re-aimed
    training history): (round, train_loss, val_loss)."""
    tr = model.evaluateEachIteration(assemble(train, feature_cols).withColumn("__label", c(label_col).cast("double")))
    va = model.evaluateEachIteration(assemble(val, feature_cols).withColumn("__label", c(label_col).cast("double")))
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(tr, va))]
    return spark.createDataFrame(rows, "round int, train_loss double, val_loss double")


def fit_with_early_stopping(config: ModelConfig, train: DataFrame, val: DataFrame, feature_cols: Sequence[str],
                            label_col: str, tol: float = 0.01) -> tuple[Model, float]:
    """Boosting with early stopping: the validation rows ride along with an
    indicator column and MLlib stops adding trees once the validation loss
    stops improving by ``tol`` (relative)."""
    if config.model_type not in (ModelType.XGBOOST, ModelType.GRADIENT_BOOSTING):
        raise ValueError("early stopping is available for the boosting models")
    both = (train.withColumn("__is_val", F.lit(False))
            .unionByName(val.withColumn("__is_val", F.lit(True))))
    data = assemble(both, feature_cols).withColumn("__label", c(label_col).cast("double"))
    est = build_model(config, len(feature_cols), "__label")
    est.setValidationIndicatorCol("__is_val")
    est.set(est.validationTol, float(tol))
    t0 = time.time()
    model = est.fit(data)
    return model, time.time() - t0


def score_with_function(df: DataFrame, feature_cols: Sequence[str], predict_proba, threshold: float = 0.5,
                        keep: Sequence[str] = ()) -> DataFrame:
    """Score with a model that is not an MLlib model: ``predict_proba`` maps
    a 2-D numpy array of features to positive-class probabilities.  It runs
    on Arrow batches inside the executors (``mapInPandas``), never row by row
    and never on the driver."""
    import numpy as np
    feats = list(feature_cols)
    keep = list(keep)
    sel = df.select(*[c(k) for k in keep], *[c(f).cast("double").alias(f"__f{i}") for i, f in enumerate(feats)])
    keep_fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep)
    schema = (keep_fields + ", " if keep_fields else "") + "probability double, prediction int"

    def run(batches):
        for pdf in batches:
            x = pdf[[f"__f{i}" for i in range(len(feats))]].to_numpy(dtype=float)
            p = np.asarray(predict_proba(x), dtype=float).reshape(len(pdf), -1)[:, -1]
            out = pdf[keep].copy() if keep else pdf.iloc[:, :0].copy()
            out["probability"] = p
            out["prediction"] = (p >= threshold).astype("int32")
            yield out
    return sel.mapInPandas(run, schema)
