"""Training histories as long tables (run..., round, metric, value).

``metric_history`` computes the series of accuracy, precision, recall, F1 and
AUC per round from scored rows; ``early_stop`` finds where patience ends each
run and which round was best until then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.numeric import safe_div
from ..session import save_table
from .cumulative import running_totals

# fixed values: the names that may be monitored
MONITORS = ("loss", "val_loss", "accuracy", "val_accuracy", "auc", "val_auc",
            "precision", "val_precision", "recall", "val_recall", "f1", "val_f1")
METRICS = ("accuracy", "precision", "recall", "f1", "auc")
#: Scores are kept this far from 0 and 1 in the cross-entropy, so that it stays finite.
_CLIP = 1e-15


def monitor_mode(monitor: str, mode: str = "auto") -> str:
    """'min' or 'max'; ``auto`` minimises losses and maximises the rest."""
    if monitor not in MONITORS:
        raise ValueError(f"unknown monitor {monitor!r}; choose from {', '.join(MONITORS)}")
    if mode not in ("min", "max", "auto"):
        raise ValueError("mode must be 'min', 'max' or 'auto'")
    return mode if mode != "auto" else "min" if monitor.endswith("loss") else "max"


def metric_history(scored: DataFrame, label_col: str, score_col: str, round_col: str = "round",
                   val_col: str | None = None, run_cols: Sequence[str] = (), metrics: Sequence[str] = METRICS,
                   threshold: float = 0.5) -> DataFrame:
    """Long history from rows scored in every round.  Rows whose boolean
    ``val_col`` is true give the ``val_`` series.  A metric that is undefined
    in a round (no predicted positives, one class only) has no row there.
    ``loss`` is the mean cross-entropy, for scores that are probabilities."""
    unknown = [m for m in metrics if m not in (*METRICS, "loss")]
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; choose from {METRICS} and loss")
    keys = [*run_cols, round_col]
    val = c(val_col) if val_col else F.lit(False)
    counts = (scored.select(*[c(k) for k in keys], val.alias("__val"), c(score_col).cast("double").alias("__s"), c(label_col).alias("__y"))
              .groupBy(*[c(k) for k in keys], "__val", "__s")
              .agg(F.count_if(F.col("__y") == 1).alias("__pos"), F.count_if(F.col("__y") == 0).alias("__neg")))
    return history_of_counts(counts, keys, metrics, threshold)


def history_of_counts(counts: DataFrame, keys: Sequence[str], metrics: Sequence[str] = METRICS, threshold: float = 0.5) -> DataFrame:
    """``metric_history`` of counted rows: the keys, ``__val``, the score
    ``__s`` and how many rows of it are positive (``__pos``) and negative
    (``__neg``); one row per key, ``__val`` and score."""
    if "auc" in metrics:
        counts = save_table(counts, "score-counts")    # read twice: for the bounds of the running totals and for the totals
    ranked = running_totals(counts, "__s", ["__neg"], [*keys, "__val"]) if "auc" in metrics else counts.withColumn("cum___neg", F.lit(0))
    hit = F.col("__s") >= F.lit(float(threshold))
    total = lambda col, when=None: F.coalesce(F.sum(F.when(when, col) if when is not None else col), F.lit(0)).cast("double")
    sure = F.greatest(F.least(F.col("__s"), F.lit(1 - _CLIP)), F.lit(_CLIP))
    entropy = -(F.col("__pos") * F.log(sure) + F.col("__neg") * F.log(1 - sure)) if "loss" in metrics else F.lit(0.0)
    k = ranked.groupBy(*[c(x) for x in keys], "__val").agg(
        F.sum(entropy).alias("entropy"),
        total(F.col("__pos"), hit).alias("tp"), total(F.col("__neg"), hit).alias("fp"),
        total(F.col("__pos")).alias("p"), total(F.col("__neg")).alias("n"),
        F.sum(F.col("__pos").cast("double") * (F.col("cum___neg") - F.col("__neg") * F.lit(0.5))).alias("below"))
    tp, fp, p, n = (F.col(x) for x in ("tp", "fp", "p", "n"))
    value = {"loss": safe_div(F.col("entropy"), p + n), "accuracy": safe_div(tp + n - fp, p + n), "precision": safe_div(tp, tp + fp), "recall": safe_div(tp, p),
             "f1": safe_div(2 * tp, tp + fp + p), "auc": safe_div(F.col("below"), p * n)}
    name = lambda m: F.when(F.col("__val"), F.lit(f"val_{m}")).otherwise(F.lit(m))
    rows = F.explode(F.array(*[F.struct(name(m).alias("metric"), value[m].alias("value")) for m in metrics])).alias("r")
    return k.select(*[c(x) for x in keys], rows).select(*[c(x) for x in keys], "r.metric", "r.value").where("value is not null")


def early_stop(history: DataFrame, monitor: str = "val_f1", mode: str = "max", patience: int = 5, min_delta: float = 0.0,
               round_col: str = "round", run_cols: Sequence[str] = ()) -> DataFrame:
    """(run..., best_round, best_value, stop_round, stopped) per run.

    A round improves if its value beats the best before it by more than
    ``min_delta``; a NULL or NaN never does.  The run stops at the first round
    that is ``patience`` rounds after the last improvement, else at its last
    round; the best round is the last improvement until then.  The windows are
    per run and span its rounds, not data rows."""
    sign = 1 if monitor_mode(monitor, mode) == "min" else -1
    if patience < 0:
        raise ValueError("patience must not be negative")
    key: Column = F.when(~F.isnan(c("value").cast("double")), c("value").cast("double") * F.lit(sign))
    rows = history.where(F.col("metric") == F.lit(monitor)).select(*[c(r) for r in run_cols], c(round_col).alias("__round"), key.alias("__v"))
    order = Window.partitionBy(*[c(r) for r in run_cols]).orderBy("__round")
    until, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    # with min_delta the best is the last improvement, which a running minimum bounds only for min_delta 0;
    # a fold over the run's values states the rule as it is
    if min_delta:
        seq = F.collect_list(F.struct(F.coalesce("__v", F.lit(float("inf"))).alias("v"))).over(until)
        start = F.struct(F.lit(float("inf")).alias("best"), F.lit(False).alias("up"))
        state = F.aggregate(seq, start, lambda a, x: F.struct(
            F.when(x["v"] < a["best"] - F.lit(float(min_delta)), x["v"]).otherwise(a["best"]).alias("best"),
            (x["v"] < a["best"] - F.lit(float(min_delta))).alias("up")))
        rows = rows.withColumn("__up", state["up"])
    else:
        best = F.min("__v").over(before)
        rows = rows.withColumn("__up", F.col("__v").isNotNull() & (best.isNull() | (F.col("__v") < best)))
    rows = rows.withColumn("__k", F.row_number().over(order))
    rows = rows.withColumn("__last", F.coalesce(F.max(F.when(F.col("__up"), F.col("__k"))).over(until), F.lit(0)))
    rows = rows.withColumn("__over", (F.col("__k") - F.col("__last")) >= F.lit(patience) if patience else ~F.col("__up"))
    rows = rows.withColumn("__stopped_before", F.coalesce(F.max(F.col("__over").cast("int")).over(before), F.lit(0)))
    run = rows.where("__stopped_before = 0")
    out = run.groupBy(*[c(r) for r in run_cols]).agg(
        F.max(F.when(F.col("__up"), F.struct("__k", "__round", "__v"))).alias("b"), F.max("__round").alias("stop_round"), F.max("__over").alias("stopped"))
    return out.select(*[c(r) for r in run_cols], F.col("b.__round").alias("best_round"), (F.col("b.__v") * sign).alias("best_value"), "stop_round", "stopped")
