"""Strategy search, model comparison and the selection summary.

The loops here run on the driver over a handful of configurations; every
step inside them (resampling, fitting, scoring, metrics) is a distributed
Spark job.  Results are small DataFrames, one row per strategy or model.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c, long_form
from ..functions.numeric import safe_div
from ..operators import history, staged
from ..operators import metrics as M
from ..operators.imbalance import class_weight_dict
from ..operators.resample import SmoteBasis, class_distribution, smote_basis, smote_from
from ..operators.train import ModelConfig, ModelType, feature_importance, fit, score
from ..session import save_table


class ImbalanceStrategy(Enum):
    NONE = "none"
    SMOTE_FULL = "smote_full"
    SMOTE_PARTIAL = "smote_partial"
    CLASS_WEIGHTS = "class_weights"
    SMOTE_PARTIAL_WEIGHTS = "smote_partial+weights"


DEFAULT_STRATEGIES = tuple(ImbalanceStrategy)
_WEIGHTED = {ImbalanceStrategy.CLASS_WEIGHTS, ImbalanceStrategy.SMOTE_PARTIAL_WEIGHTS}


def parse_strategy(s) -> ImbalanceStrategy:
    if isinstance(s, ImbalanceStrategy):
        return s
    try:
        return ImbalanceStrategy(s)
    except ValueError as e:
        opts = ", ".join(x.value for x in ImbalanceStrategy)
        raise ValueError(f"Unknown strategy {s!r}. Valid options: {opts}") from e


def resample_for_strategy(train: DataFrame, key_col: str, label_col: str, feature_cols: Sequence[str],
                          strategy, smote_ratio: float = 0.5, class_weights: Mapping | None = None,
                          auto_calculate_weights: bool = True, seed: int = 42, basis: SmoteBasis | None = None
                          ) -> tuple[DataFrame, dict | None]:
    """(training table, class weights or None) for a strategy.  Weights are
    computed from the labels **before** any oversampling."""
    st = parse_strategy(strategy)
    if class_weights is not None and auto_calculate_weights:
        raise ValueError("Pass class_weights or auto_calculate_weights=True, not both")
    if class_weights is not None and st not in _WEIGHTED:
        raise ValueError(f"class_weights given but strategy {st.value} does not use weights")
    weights = None
    if st in _WEIGHTED:
        weights = dict(class_weights) if class_weights is not None else class_weight_dict(train, label_col)
    if st in (ImbalanceStrategy.SMOTE_FULL, ImbalanceStrategy.SMOTE_PARTIAL,
              ImbalanceStrategy.SMOTE_PARTIAL_WEIGHTS):
        ratio = 1.0 if st == ImbalanceStrategy.SMOTE_FULL else smote_ratio
        basis = basis or smote_basis(train, key_col, label_col, feature_cols, seed=seed)
        train = smote_from(train, basis, ratio).checkpoint()
    # (the oversampled table is read by every optimiser iteration: its kNN
    # lineage is cut once)
    return train, weights


def validation_metrics(scored: DataFrame, label_col: str) -> dict:
    """accuracy, precision, recall, f1 (threshold already applied) and AUC.
    Rows are scored once and saved: each figure reads the scores several times."""
    scored = save_table(scored.select(c(label_col), "probability", "prediction"), "scored")
    m = M.basic_metrics(scored, label_col, "prediction").first().asDict()
    m["roc_auc"] = M.roc_auc_value(scored, label_col, "probability")
    return m


@dataclass
class StrategyResult:
    strategy: str
    smote_ratio: float | None
    metrics: dict
    n_before: int
    n_after: int
    dist_before: dict
    dist_after: dict
    train_time_s: float
    model: object = field(repr=False, default=None)


def train_with_strategy(model_config: ModelConfig, train: DataFrame, val: DataFrame, key_col: str,
                        label_col: str, feature_cols: Sequence[str], strategy, smote_ratio: float = 0.5,
                        class_weights: Mapping | None = None, auto_calculate_weights: bool = True,
                        threshold: float = 0.5, seed: int = 42, basis: SmoteBasis | None = None,
                        train_fn: Callable | None = None) -> StrategyResult:
    """Resample or weight, fit, score the validation rows at ``threshold``,
    and record sample counts and class distributions before and after.
    ``train_fn(train_df, val_df, class_weights)`` replaces the built-in fit
    (it must return a model whose ``transform`` adds ``probability``)."""
    st = parse_strategy(strategy)
    if class_weights is not None:
        auto_calculate_weights = False
    data, weights = resample_for_strategy(train, key_col, label_col, feature_cols, st, smote_ratio,
                                          class_weights, auto_calculate_weights, seed, basis)
    before = {r["class"]: r["count"] for r in class_distribution(train, label_col).collect()}
    after = {r["class"]: r["count"] for r in class_distribution(data, label_col).collect()}
    if train_fn is not None:
        # user hook: (training table, validation table, class weights) -> fitted MLlib model
        import time as _time
        t0 = _time.time()
        model = train_fn(data, val, weights)
        secs = _time.time() - t0
    else:
        model, secs = fit(model_config, data, feature_cols, label_col, weights)
    scored = score(model, val, feature_cols, threshold, keep=[label_col])
    ratio = smote_ratio if st in (ImbalanceStrategy.SMOTE_PARTIAL, ImbalanceStrategy.SMOTE_PARTIAL_WEIGHTS) \
        else (1.0 if st == ImbalanceStrategy.SMOTE_FULL else None)
    return StrategyResult(st.value, ratio, validation_metrics(scored, label_col), sum(before.values()),
                          sum(after.values()), before, after, secs, model)


def _rank(spark: SparkSession, rows: list[dict], metric: str, schema: str) -> DataFrame:
    ordered = sorted(rows, key=lambda r: (-(r[metric] if r[metric] is not None else float("-inf")), r["name"]))
    for i, r in enumerate(ordered, 1):
        r["rank"] = i
    return spark.createDataFrame(ordered, schema)  # one row per strategy / model


_RESULT_COLS = ("rank int, name string, {extra} accuracy double, precision double, recall double, "
                "f1 double, roc_auc double, recall_weighted double, train_time_s double")


def _run_all(tasks: dict, parallelism: int) -> dict:
    """Run independent fits from a thread pool (as MLlib's own tuning does):
    each fit is a sequence of small Spark jobs, so several at once keep the
    cluster busy.  Results do not depend on the order."""
    if parallelism <= 1 or len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def optimize_strategy(model_builder: Callable[[], ModelConfig], train: DataFrame, val: DataFrame, key_col: str,
                      label_col: str, feature_cols: Sequence[str], strategies: Sequence = DEFAULT_STRATEGIES,
                      smote_ratios: Sequence[float] = (0.5,), optimize_for: str = "f1", seed: int = 42,
                      parallelism: int = 4) -> tuple[DataFrame, dict[str, StrategyResult]]:
    """Every strategy (SMOTE strategies once per ratio, key
    ``strategy@ratio``) with a fresh model from ``model_builder``; a table
    ranked by ``optimize_for`` (ties by name) and the results by key.
    Up to ``parallelism`` fits run at the same time (``train_time_s`` is
    then the wall time of a fit sharing the cluster)."""
    # the neighbour graph does not depend on the strategy or the ratio: once
    needs_smote = any(parse_strategy(s) not in (ImbalanceStrategy.NONE, ImbalanceStrategy.CLASS_WEIGHTS)
                      for s in strategies)
    basis = smote_basis(train, key_col, label_col, feature_cols, seed=seed) if needs_smote else None
    tasks = {}
    for s in strategies:
        st = parse_strategy(s)
        ratios = smote_ratios if st in (ImbalanceStrategy.SMOTE_PARTIAL,
                                        ImbalanceStrategy.SMOTE_PARTIAL_WEIGHTS) else [None]
        for r in ratios:
            name = st.value if r is None else f"{st.value}@{r}"
            tasks[name] = (lambda st=st, r=r: train_with_strategy(
                model_builder(), train, val, key_col, label_col, feature_cols, st,
                r if r is not None else 0.5, seed=seed, basis=basis))
    results: dict[str, StrategyResult] = _run_all(tasks, parallelism)
    rows = []
    for name, res in results.items():
        m = res.metrics
        rw = 0.3 * m["roc_auc"] + 0.6 * m["recall"] + 0.1 * m["f1"] if m["roc_auc"] is not None else None
        rows.append({"name": name, "strategy": res.strategy, "smote_ratio": res.smote_ratio,
                     "n_before": res.n_before, "n_after": res.n_after, **{k: m[k] for k in
                     ("accuracy", "precision", "recall", "f1", "roc_auc")}, "recall_weighted": rw,
                     "train_time_s": res.train_time_s})
    schema = _RESULT_COLS.format(extra="strategy string, smote_ratio double, n_before long, n_after long,")
    return _rank(train.sparkSession, rows, optimize_for, schema), results


@dataclass
class ModelResult:
    name: str
    model_type: str
    metrics: dict
    train_time_s: float
    scored: DataFrame = field(repr=False)
    importance: DataFrame | None = field(repr=False, default=None)
    model: object = field(repr=False, default=None)


def train_and_evaluate(config: ModelConfig, train: DataFrame, test: DataFrame, label_col: str,
                       feature_cols: Sequence[str], key_col: str | None = None,
                       threshold: float = 0.5) -> ModelResult:
    """Fit (class weights per config; XGBoost gets scale_pos_weight), score
    the test rows, five metrics, and feature importance when available."""
    spw = None
    if config.model_type == ModelType.XGBOOST and config.class_weight is not None:
        counts = {r["class"]: r["count"] for r in class_distribution(train, label_col).collect()}
        spw = counts.get(0, 0) / counts[1] if counts.get(1) else None
    cw = None if config.model_type in (ModelType.XGBOOST, ModelType.GRADIENT_BOOSTING) else config.class_weight
    model, secs = fit(config, train, feature_cols, label_col, cw, spw)
    scored = score(model, test, feature_cols, threshold, keep=[x for x in (key_col, label_col) if x])
    return ModelResult(config.name, config.model_type.value, validation_metrics(scored, label_col), secs,
                       scored, feature_importance(model, feature_cols, train.sparkSession), model)


def compare_models(configs: Sequence[ModelConfig], train: DataFrame, test: DataFrame, label_col: str,
                   feature_cols: Sequence[str], optimize_for: str = "f1", parallelism: int = 4
                   ) -> tuple[DataFrame, dict[str, ModelResult]]:
    """One row per model, ranked by ``optimize_for``; up to ``parallelism``
    models are fitted at the same time."""
    results = _run_all({cfg.name: (lambda cfg=cfg: train_and_evaluate(cfg, train, test, label_col, feature_cols))
                        for cfg in configs}, parallelism)
    rows = []
    for name, res in results.items():
        m = res.metrics
        rw = 0.3 * m["roc_auc"] + 0.6 * m["recall"] + 0.1 * m["f1"] if m["roc_auc"] is not None else None
        rows.append({"name": name, "model_type": res.model_type, **{k: m[k] for k in
                     ("accuracy", "precision", "recall", "f1", "roc_auc")}, "recall_weighted": rw,
                     "train_time_s": res.train_time_s})
    return _rank(train.sparkSession, rows, optimize_for,
                 _RESULT_COLS.format(extra="model_type string,")), results


def best_epoch(history: DataFrame, monitor: str = "val_loss", mode: str = "min",
               round_col: str = "round") -> DataFrame:
    """First round with the best monitored value: (best_round, best_value).
    ``history`` has a column per series, or is long (round, metric, value)."""
    if mode not in ("min", "max"):
        raise ValueError("mode must be 'min' or 'max'")
    if {"metric", "value"} <= set(history.columns):
        history = history.where(F.col("metric") == F.lit(monitor)).select(c(round_col), c("value").alias(monitor))
    key = F.struct((c(monitor) if mode == "min" else -c(monitor)).alias("v"), c(round_col).alias("r"))
    best = history.agg(F.min(key).alias("b"))
    return best.select(F.col("b.r").alias("best_round"),
                       (F.col("b.v") if mode == "min" else -F.col("b.v")).alias("best_value"))


def strategy_rows(results: Mapping[str, StrategyResult], val: DataFrame, feature_cols: Sequence[str], label_col: str,
                  monitor: str = "val_auc", mode: str = "auto") -> DataFrame:
    """One row per strategy: (strategy, train_samples, class_distribution,
    monitor, best_value, best_round).  The best round is the first with the
    best monitored value on the validation rows; NULL for models that are not
    fitted in rounds.  Only ``val_`` series can be monitored."""
    if not monitor.startswith("val_"):
        raise ValueError("monitor a series of the validation rows")
    mode, rows = history.monitor_mode(monitor, mode), []
    for name, res in results.items():
        best = None
        if hasattr(res.model, "trees") and hasattr(res.model, "treeWeights") and hasattr(res.model, "evaluateEachIteration"):
            series = staged.fit_history(res.model, val.where(F.lit(False)), val, feature_cols, label_col, metrics=[monitor.removeprefix("val_")])
            best = best_epoch(series, monitor, mode).first()
        spread = ", ".join(f"({k}:{v:,})" for k, v in sorted(res.dist_after.items(), key=lambda x: str(x[0])))
        rows.append((name, res.n_after, spread, monitor, best["best_value"] if best else None, best["best_round"] if best else None))
    return val.sparkSession.createDataFrame(rows, "strategy string, train_samples long, class_distribution string, monitor string, best_value double, best_round int")


def all_results(summary: DataFrame, strategies: DataFrame) -> DataFrame:
    """The summary of the chosen strategy and the rows of all of them as
    (result, label, at, metric, value)."""
    numbers = [n for n in summary.columns if n != "best_strategy"]
    return long_form(summary, "best", numbers, F.col("best_strategy")).unionByName(
        long_form(strategies, "strategy", ["train_samples", "best_value", "best_round"], F.concat_ws(" ", "strategy", "class_distribution")))


def selection_summary(ranking: DataFrame, test_scored: DataFrame, label_col: str, threshold: float,
                      name: str) -> DataFrame:
    """One row: the chosen strategy and its validation AUC, the threshold,
    the confusion counts at that threshold (not at 0.5) with their rates,
    positives caught, the baseline catch rate (minority share of the test
    rows, in percent) and the test AUC.  All test figures come from one
    aggregate over the scored rows; the two AUCs are scalars."""
    chosen = ranking.where(F.col("name") == F.lit(name)).select("roc_auc").first()
    val_auc = chosen["roc_auc"] if chosen else None
    test_auc = M.roc_auc_value(test_scored, label_col, "probability")
    y = c(label_col)
    pred = M.predict(F.col("probability"), threshold)
    k = test_scored.agg(F.count_if((y == 0) & (pred == 0)).alias("tn"),
                        F.count_if((y == 0) & (pred == 1)).alias("fp"),
                        F.count_if((y == 1) & (pred == 0)).alias("fn"),
                        F.count_if((y == 1) & (pred == 1)).alias("tp"),
                        F.count(F.lit(1)).alias("n"))
    pos, neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    return k.select(
        F.lit(name).alias("best_strategy"), F.lit(val_auc).cast("double").alias("val_roc_auc"),
        F.lit(float(threshold)).alias("threshold"), "tn", "fp", "fn", "tp",
        (safe_div(F.col("tn"), neg) * 100).alias("tn_pct"), (safe_div(F.col("fp"), neg) * 100).alias("fp_pct"),
        (safe_div(F.col("fn"), pos) * 100).alias("fn_pct"), (safe_div(F.col("tp"), pos) * 100).alias("recall_pct"),
        safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        pos.alias("total_positives"), F.col("tp").alias("positives_caught"),
        (safe_div(pos, F.col("n")) * 100).alias("baseline_catch_rate"),
        F.lit(test_auc).cast("double").alias("test_roc_auc"))
