"""Evaluate a fitted model on a test table: every metric operator over one
scored DataFrame.

The scored table (key, label, probability) is checkpointed once -- to the
shared folder named by ``spark.checkpoint.dir`` -- so the six reports that
read it neither re-score the test rows nor depend on executors that may be
gone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import long_form
from ..operators import metrics as M
from ..operators.train import score
from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class ModelEvaluation:
    scored: DataFrame
    confusion_matrix: DataFrame
    classification_report: DataFrame
    roc_curve: DataFrame
    roc_auc: DataFrame
    pr_curve: DataFrame
    threshold_sweep: DataFrame
    best_threshold: DataFrame


_SWEEP = ("tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1", "metric_value")


def all_results(ev: ModelEvaluation) -> DataFrame:
    """Every result of an evaluation as (result, label, at, metric, value):
    ``label`` is the class (of the matrix ``actual:predicted``, of the AUC its
    grade), ``at`` the threshold."""
    at = F.col("threshold")
    parts = [
        long_form(ev.confusion_matrix, "confusion_matrix", ["count"], F.concat_ws(":", F.col("actual").cast("string"), F.col("predicted").cast("string"))),
        long_form(ev.classification_report, "classification_report", ["precision", "recall", "f1_score", "support"], F.col("class")),
        long_form(ev.roc_curve, "roc_curve", ["fpr", "tpr"], at=at),
        long_form(ev.roc_auc, "roc_auc", ["roc_auc"], F.col("grade")),
        long_form(ev.pr_curve, "pr_curve", ["precision", "recall"], at=at),
        long_form(ev.threshold_sweep, "threshold_sweep", _SWEEP, at=at),
        long_form(ev.best_threshold, "best_threshold", _SWEEP, at=at)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluate_scored(scored: DataFrame, label_col: str = "label", score_col: str = "probability",
                    thresholds: Sequence[float] = M.DEFAULT_THRESHOLDS,
                    optimize_for: str = "f1") -> ModelEvaluation:
    auc = M.roc_auc_value(scored, label_col, score_col)
    at_half = M.with_prediction(scored, score_col, 0.5)
    sweep = M.threshold_sweep(scored, label_col, score_col, thresholds, optimize_for, auc)
    return ModelEvaluation(
        scored, M.confusion_matrix(at_half, label_col, "prediction"),
        M.classification_report(at_half, label_col, "prediction"),
        M.roc_curve(scored, label_col, score_col), M.roc_auc(scored, label_col, score_col),
        M.pr_curve(scored, label_col, score_col), sweep, M.best_threshold(sweep))


def evaluate_model(model, test: DataFrame, feature_cols: Sequence[str], label_col: str, key_col: str,
                   thresholds: Sequence[float] = M.DEFAULT_THRESHOLDS, optimize_for: str = "f1"
                   ) -> ModelEvaluation:
    ensure_checkpoint_dir(test.sparkSession)
    scored = score(model, test, feature_cols, 0.5, keep=[key_col, label_col]).drop("prediction")
    scored = scored.checkpoint()
    return evaluate_scored(scored, label_col, "probability", thresholds, optimize_for)
