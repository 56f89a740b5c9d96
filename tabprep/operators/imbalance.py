"""Class imbalance report, class weights, positive-class weight.

All numbers come from ``groupBy(label).count()`` (partial aggregation: a
class holding most rows costs one row per map task) and small aggregates
over that per-class table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..functions.numeric import safe_div
from ..functions.text import format_ratio

# Severity bands of the majority/minority ratio, with the
# recommended action for each band.
SEVERITY_BANDS = (
    (1.5, "Balanced ✅", "No special handling needed"),
    (3.0, "Slight Imbalance ⚠️", "Monitor metrics closely"),
    (9.0, "Moderate Imbalance 🟡", "Use class weights or resampling"),
    (99.0, "Severe Imbalance 🟠", "Special techniques required (SMOTE, heavy class weights)"),
)
EXTREME = ("Extreme Imbalance 🔴", "Consider anomaly detection approaches")


def severity(ratio: Column) -> Column:
    out = F.lit(EXTREME[0])
    for bound, label, _ in reversed(SEVERITY_BANDS):
        out = F.when(ratio < F.lit(bound), F.lit(label)).otherwise(out)
    return out


def recommended_action(ratio: Column) -> Column:
    out = F.lit(EXTREME[1])
    for bound, _, action in reversed(SEVERITY_BANDS):
        out = F.when(ratio < F.lit(bound), F.lit(action)).otherwise(out)
    return out


def class_counts(df: DataFrame, target_col: str) -> DataFrame:
    """(class, count); NULL labels dropped."""
    return (df.where(c(target_col).isNotNull()).groupBy(c(target_col).alias("class"))
            .agg(F.count(F.lit(1)).alias("count")))


def display_label(cls: Column, class_labels: Mapping | None) -> Column:
    """``Class {v} ({label})`` when a label is known, else ``Class {v}``."""
    base = F.concat(F.lit("Class "), cls.cast("string"))
    if not class_labels:
        return base
    m = F.create_map(*[x for k, v in class_labels.items() for x in (F.lit(k), F.lit(v))])
    lab = m[cls]
    return F.when(lab.isNotNull(), F.concat(base, F.lit(" ("), lab, F.lit(")"))).otherwise(base)


def _with_extremes(counts: DataFrame) -> DataFrame:
    """Per-class table plus majority/minority columns.  Ties go to the
    smallest class value.  The window spans the per-class table only."""
    every = Window.partitionBy()
    return counts.select(
        "*",
        F.sum("count").over(every).alias("total"),
        F.count(F.lit(1)).over(every).alias("n_classes"),
        F.max("count").over(every).alias("majority_count"),
        F.min("count").over(every).alias("minority_count"),
        F.min(F.struct((-F.col("count")).alias("k"), F.col("class").alias("v"))).over(every)
        .getField("v").alias("majority_class"),
        F.min(F.struct(F.col("count").alias("k"), F.col("class").alias("v"))).over(every)
        .getField("v").alias("minority_class"))


def imbalance_classes(df: DataFrame, target_col: str, class_labels: Mapping | None = None) -> DataFrame:
    """One row per class, by count descending: count, percent, ratio to the
    majority and to the minority class, display label."""
    t = _with_extremes(class_counts(df, target_col))
    return t.select(
        "class", display_label(F.col("class"), class_labels).alias("class_label_display"), "count",
        (safe_div(F.col("count"), F.col("total")) * F.lit(100.0)).alias("percentage"),
        safe_div(F.col("majority_count"), F.col("count")).alias("ratio_to_majority"),
        safe_div(F.col("count"), F.col("minority_count")).alias("ratio_to_minority"),
    ).orderBy(F.col("count").desc(), "class")


def check_imbalance(df: DataFrame, target_col: str, class_labels: Mapping | None = None) -> DataFrame:
    """One summary row: classes, total, majority/minority class and count,
    their display labels, minority percent, ratio, severity and action."""
    t = _with_extremes(class_counts(df, target_col))
    one = t.where(F.col("class") == F.col("majority_class"))
    ratio = safe_div(F.col("majority_count"), F.col("minority_count"))
    minority_pct = safe_div(F.col("minority_count"), F.col("total")) * F.lit(100.0)
    return one.select(
        F.lit(target_col).alias("target_column"), "n_classes",
        F.col("total").alias("total_samples"),
        "majority_class", "majority_count", "minority_class", "minority_count",
        display_label(F.col("majority_class"), class_labels).alias("majority_label"),
        display_label(F.col("minority_class"), class_labels).alias("minority_label"),
        F.format_string("%.2f%%", F.round(minority_pct, 2)).alias("minority_percentage"),
        ratio.alias("ratio"), format_ratio(F.round(ratio, 2), 2).alias("imbalance_ratio"),
        severity(ratio).alias("severity"), recommended_action(ratio).alias("recommended_action"))


def class_weights(df: DataFrame, target_col: str) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class, plus, for two classes,
    the ratio ``w(larger class value) / w(smaller)``."""
    t = class_counts(df, target_col)
    every = Window.partitionBy()  # per-class table
    w = t.select("class", "count",
                 safe_div(F.sum("count").over(every),
                          F.count(F.lit(1)).over(every) * F.col("count")).alias("weight"))
    return w.select("*", F.when(F.count(F.lit(1)).over(every) == 2,
                                safe_div(F.max_by("weight", "class").over(every),
                                         F.min_by("weight", "class").over(every))).alias("weight_ratio"))


def class_weight_dict(df: DataFrame, target_col: str) -> dict:
    """Weights as a dict (one entry per class reaches the driver)."""
    return {r["class"]: r["weight"] for r in class_weights(df, target_col).collect()}


def scale_pos_weight(df: DataFrame, target_col: str) -> DataFrame:
    """``count(y == 0) / count(y == 1)``."""
    y = c(target_col)
    return df.agg(safe_div(F.count_if(y == 0), F.count_if(y == 1)).alias("scale_pos_weight"))


def with_weight_column(df: DataFrame, target_col: str, weights: Mapping | None = None,
                       weight_col: str = "weight") -> DataFrame:
    """Attach a per-row class weight (a literal map of one entry per class,
    computed if not given)."""
    weights = dict(weights or class_weight_dict(df, target_col))
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn(weight_col, F.coalesce(m[c(target_col)], F.lit(1.0)))
