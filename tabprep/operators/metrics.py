"""Classification metrics over a scored table (label, score[, prediction]).

Counts are conditional sums in one aggregate; curves aggregate by distinct
score first (so a score shared by a third of the rows is one row) and then
take running totals with ``running_totals`` (range-bucketed, never a single
global window task over the data).  AUC is exact: no binning.
"""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.numeric import safe_div
from ..session import save_table
from .cumulative import running_totals

DEFAULT_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
_MAX_CLASSES = 10_000

# AUC grade bands.
AUC_GRADES = ((0.9, "Excellent discrimination ability"), (0.8, "Good discrimination ability"),
              (0.7, "Fair discrimination ability"))
AUC_GRADE_ELSE = "Poor discrimination ability"


class OptimizationMetric(Enum):
    ACCURACY = "accuracy"
    PRECISION = "precision"
    RECALL = "recall"
    F1 = "f1"
    ROC_AUC = "roc_auc"
    RECALL_WEIGHTED = "recall_weighted"


def predict(score: Column, threshold: float = 0.5) -> Column:
    """Class 1 when ``score >= threshold``."""
    return (score >= F.lit(float(threshold))).cast("int")


def with_prediction(df: DataFrame, score_col: str = "score", threshold: float = 0.5,
                    prediction_col: str = "prediction") -> DataFrame:
    return df.withColumn(prediction_col, predict(c(score_col), threshold))


def auc_grade(auc: Column) -> Column:
    out = F.lit(AUC_GRADE_ELSE)
    for bound, label in reversed(AUC_GRADES):
        out = F.when(auc >= F.lit(bound), F.lit(label)).otherwise(out)
    return out


def recall_weighted(roc_auc: Column, recall: Column, f1: Column) -> Column:
    """0.3 * AUC + 0.6 * recall + 0.1 * F1"""
    return F.lit(0.3) * roc_auc + F.lit(0.6) * recall + F.lit(0.1) * f1


def optimization_metric(metric: OptimizationMetric | str, accuracy: Column | None = None,
                        precision: Column | None = None, recall: Column | None = None,
                        f1: Column | None = None, roc_auc: Column | None = None) -> Column:
    """The column a search ranks by.  Unknown type -> TypeError; a metric
    whose inputs are missing -> ValueError."""
    if isinstance(metric, str):
        try:
            metric = OptimizationMetric(metric)
        except ValueError as e:
            raise TypeError(f"unknown optimization metric {metric!r}") from e
    elif type(metric) is not OptimizationMetric:
        raise TypeError(f"a metric or its name is wanted, not {metric!r}")
    need = {OptimizationMetric.ACCURACY: [accuracy], OptimizationMetric.PRECISION: [precision],
            OptimizationMetric.RECALL: [recall], OptimizationMetric.F1: [f1],
            OptimizationMetric.ROC_AUC: [roc_auc],
            OptimizationMetric.RECALL_WEIGHTED: [roc_auc, recall, f1]}[metric]
    if any(x is None for x in need):
        raise ValueError(f"{metric.value} needs inputs that were not given")
    if metric == OptimizationMetric.RECALL_WEIGHTED:
        return recall_weighted(roc_auc, recall, f1)
    return need[0]


# ------------------------------------------------------------------ counts
def _binary_counts(label: Column, pred: Column) -> list[Column]:
    return [F.count_if((label == 0) & (pred == 0)).alias("tn"),
            F.count_if((label == 0) & (pred == 1)).alias("fp"),
            F.count_if((label == 1) & (pred == 0)).alias("fn"),
            F.count_if((label == 1) & (pred == 1)).alias("tp")]


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    """accuracy, precision, recall, F1 of class 1; 0 where undefined."""
    zero = F.lit(0.0)
    acc = F.coalesce(safe_div(tp + tn, tp + tn + fp + fn), zero)
    prec = F.coalesce(safe_div(tp, tp + fp), zero)
    rec = F.coalesce(safe_div(tp, tp + fn), zero)
    f1 = F.coalesce(safe_div(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn), zero)
    return [acc.alias("accuracy"), prec.alias("precision"), rec.alias("recall"), f1.alias("f1")]


def confusion_rates(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """Binary TN/FP/FN/TP and each as a percent of its actual class."""
    k = df.agg(*_binary_counts(c(label_col), c(prediction_col)))
    neg, pos = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp")
    return k.select("tn", "fp", "fn", "tp",
                    (safe_div(F.col("tn"), neg) * 100).alias("tn_pct"),
                    (safe_div(F.col("fp"), neg) * 100).alias("fp_pct"),
                    (safe_div(F.col("fn"), pos) * 100).alias("fn_pct"),
                    (safe_div(F.col("tp"), pos) * 100).alias("tp_pct"))


def basic_metrics(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, F1 for class 1 (zero_division = 0)."""
    k = df.agg(*_binary_counts(c(label_col), c(prediction_col)))
    return k.select(*_rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def _classes(df: DataFrame, label_col: str, prediction_col: str) -> list:
    vals = (df.select(c(label_col).alias("v")).union(df.select(c(prediction_col).alias("v")))
            .where(F.col("v").isNotNull()).distinct().limit(_MAX_CLASSES + 1).collect())
    if len(vals) > _MAX_CLASSES:
        raise ValueError(f"more than {_MAX_CLASSES} classes")
    return sorted(r["v"] for r in vals)


def _cells(df: DataFrame, label_col: str, prediction_col: str, labels: Sequence | None) -> DataFrame:
    """(actual, predicted, n) of the cells that occur, among ``labels`` if given."""
    counts = df.groupBy(c(label_col).alias("actual"), c(prediction_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")).where("actual is not null and predicted is not null")
    return counts if labels is None else counts.where(F.col("actual").isin(list(labels)) & F.col("predicted").isin(list(labels)))


def confusion_matrix(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                     labels: Sequence | None = None, dense: bool = True) -> DataFrame:
    """(actual, predicted, count) for every pair of classes, 0 for absent
    cells; classes ascending.  The class list (one entry per class) is the
    only thing that reaches the driver.  ``dense=False`` returns the cells
    that occur, for any number of classes, and collects nothing; the dense
    form of k classes has k^2 rows and is refused beyond ``_MAX_CLASSES``."""
    counts = _cells(df, label_col, prediction_col, labels)
    if not dense:
        return counts.withColumnRenamed("n", "count")
    classes = list(labels) if labels is not None else _classes(df, label_col, prediction_col)
    arr = F.array(*[F.lit(v) for v in classes])
    grid = counts.sparkSession.range(1).select(F.explode(arr).alias("actual")).select(
        "actual", F.explode(arr).alias("predicted"))
    # the grid has (classes)^2 rows built from literals
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count")))


def confusion_matrix_norm(cm: DataFrame) -> DataFrame:
    """Each row of the matrix divided by its row (actual class) total."""
    row = Window.partitionBy("actual")  # one row per predicted class
    return cm.withColumn("share", safe_div(F.col("count"), F.sum("count").over(row)))


def classification_report(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                          labels: Sequence | None = None) -> DataFrame:
    """Per class precision / recall / F1 / support, then ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows (precision and recall are NULL
    on the accuracy row, whose F1 column holds the accuracy)."""
    # the cells that occur feed four aggregates below: one scan of the scored
    # rows, the result written to the shared folder
    cells = save_table(_cells(df, label_col, prediction_col, labels), "confusion")
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("p"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("t")),
        F.struct(F.col("predicted").cast(cells.schema["actual"].dataType).alias("cls"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("t")))).alias("x")).select("x.*")
    if labels is not None:                            # classes without any row
        sides = sides.unionByName(df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v).cast(cells.schema["actual"].dataType) for v in labels])).alias("cls"))
                                  .select("cls", *[F.lit(0).cast("bigint").alias(k) for k in "apt"]))
    per = sides.groupBy("cls").agg(F.sum("t").alias("tp"), F.sum("a").alias("support"), F.sum("p").alias("pred_total"))
    zero = F.lit(0.0)
    t = per.select(
        "cls", "tp", "support",
        F.coalesce(safe_div(F.col("tp"), F.col("pred_total")), zero).alias("precision"),
        F.coalesce(safe_div(F.col("tp"), F.col("support")), zero).alias("recall"))
    t = t.withColumn("f1_score", F.coalesce(safe_div(
        F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero))
    classes = t.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1_score",
                       F.col("support").cast("long").alias("support"))
    summary = t.agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        safe_div(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("wf"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        F.col("n").cast("long").alias("support"))
    none = F.lit(None)
    rows = summary.select(F.explode(F.array(
        row("accuracy", none, none, safe_div(F.col("tp"), F.col("n"))),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
    )).alias("r")).select("r.*")
    return classes.unionByName(rows)


# ------------------------------------------------------------------ curves
def score_table(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(score, pos, neg) per distinct score: the input of every curve."""
    y = c(label_col)
    return (df.where(c(score_col).isNotNull() & y.isNotNull())
            .groupBy(c(score_col).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def _cumulative(df, label_col, score_col):
    st = score_table(df, label_col, score_col)
    return running_totals(st, "score", ["pos", "neg"], descending=True)


def roc_curve(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (descending), plus the
    (0, 0) start with threshold +inf."""
    cum = _cumulative(df, label_col, score_col)
    pts = cum.select(F.col("score").alias("threshold"),
                     safe_div(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                     safe_div(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Exact ROC AUC (ties count one half) and its grade.

    Each distinct score contributes pos * (negatives scored lower + ties / 2);
    no curve needs to be materialised in order.
    """
    cum = _cumulative(df, label_col, score_col)
    below = F.col("tot_neg") - F.col("cum_neg")
    # P * N overflows a long for very large tables: multiply as doubles
    auc = safe_div(F.sum(F.col("pos").cast("double") * (below + F.col("neg") / F.lit(2.0))),
                   F.first("tot_pos").cast("double") * F.first("tot_neg").cast("double"))
    return cum.agg(auc.alias("roc_auc")).withColumn("grade", auc_grade(F.col("roc_auc")))


def roc_auc_value(df: DataFrame, label_col: str = "label", score_col: str = "score") -> float | None:
    """AUC without ordering: pos_s * (neg below s + neg_s / 2) needs the
    negatives below each score, which here come from the same bucketed
    running totals; one scalar reaches the driver."""
    return roc_auc(df, label_col, score_col).first()["roc_auc"]


def pr_curve(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the
    (precision 1, recall 0) end point with a NULL threshold."""
    cum = _cumulative(df, label_col, score_col)
    pts = cum.select(F.col("score").alias("threshold"),
                     F.coalesce(safe_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")),
                                F.lit(0.0)).alias("precision"),
                     F.coalesce(safe_div(F.col("cum_pos"), F.col("tot_pos")), F.lit(1.0)).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def pr_baseline(df: DataFrame, label_col: str = "label") -> DataFrame:
    """The no-skill precision: the positive rate."""
    return df.agg(F.avg((c(label_col) == 1).cast("double")).alias("positive_rate"))


# ------------------------------------------------------------------ threshold sweep
def threshold_sweep(df: DataFrame, label_col: str = "label", score_col: str = "score",
                    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
                    metric: OptimizationMetric | str = OptimizationMetric.F1,
                    roc_auc: float | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 and the chosen metric at each
    threshold.  One pass: two conditional counts per threshold in a single
    aggregate, then one row per threshold."""
    y, s = c(label_col), c(score_col)
    aggs = [F.count_if(y == 1).alias("P"), F.count_if(y != 1).alias("N")]
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(float(t))
        aggs += [F.count_if(hit & (y == 1)).alias(f"tp{i}"), F.count_if(hit & (y != 1)).alias(f"fp{i}")]
    k = df.agg(*aggs)
    rows = k.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("seq"), F.lit(float(t)).alias("threshold"),
                 F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                 (F.col("P") - F.col(f"tp{i}")).alias("fn"), (F.col("N") - F.col(f"fp{i}")).alias("tn"))
        for i, t in enumerate(thresholds)])).alias("r")).select("r.*")
    rates = rows.select("seq", "threshold", "tn", "fp", "fn", "tp",
                        *_rates(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    auc = F.lit(roc_auc).cast("double") if roc_auc is not None else None
    m = optimization_metric(metric, F.col("accuracy"), F.col("precision"), F.col("recall"), F.col("f1"), auc)
    return rates.withColumn("metric_value", m)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The sweep row with the largest metric; the first threshold on ties."""
    return sweep.orderBy(F.col("metric_value").desc_nulls_last(), F.col("seq").asc()).limit(1)


def cost_benefit(sweep: DataFrame, fn, name: str = "cost") -> DataFrame:
    """Evaluate a user function of (threshold, fn, fp, tp, tn) -- written
    with Column arithmetic, e.g. ``lambda t, fn, fp, tp, tn: 500 * fn + 50 * fp``
    -- on every row of a threshold sweep."""
    return sweep.withColumn(name, fn(F.col("threshold"), F.col("fn"), F.col("fp"), F.col("tp"), F.col("tn")))
