"""Registered queries: one per operator of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame built from the driver
tables (directly or through the derived views in ``sources.fixtures``).
Double outputs are rounded to 6 decimals so that the oracle comparison is
insensitive to summation order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import c, nan_to_null
from ..operators import (clean, corr, encode, features, groups, hist, history, imbalance, metrics, neighbors,
                         outliers, profile, resample, scale, split, staged)
from ..functions import convert
from ..operators import train as T_
from ..streaming import stream as S_
from . import analysis, evaluation, preparation, selection
from ..operators.clean import CaseStyle, FillStrategy
from ..sources import fixtures as fx
from ..functions.text import DEFAULT_MISSING_VALUES
from ..session import ensure_checkpoint_dir
from ..sources.tables import csv_scan, read_table

DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (the oracle compares rounded values)."""
    return df.select([
        F.round(c(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else c(f.name) for f in df.schema.fields])


def _t(spark, sf, name):
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- clean
def q_clean_object_columns(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.dirty_events(spark, sf)
    return clean.clean_object_columns(d).select("event_id", "label")


def q_clean_replace_upper_spaces(spark, sf):
    d = fx.dirty_events(spark, sf)
    return clean.clean_object_columns(d, replacement="missing", case_style=CaseStyle.UPPER,
                                      normalize_spaces=True).select("event_id", "label")


def q_clean_no_strip_lower(spark, sf):
    d = fx.dirty_events(spark, sf)
    return clean.clean_object_columns(d, strip_whitespace=False, replacement="n/a",
                                      case_style=CaseStyle.LOWER).select("event_id", "label")


def q_case_title(spark, sf):
    d = fx.dirty_events(spark, sf)
    return clean.clean_object_columns(d, column_case_styles={"label": CaseStyle.TITLE},
                                      normalize_spaces=True).select("event_id", "label")


def _fill(strategy, **kw):
    def q(spark, sf):
        d = fx.dirty_events(spark, sf)
        out = clean.clean_numeric_columns(d, ["value", "bucket"], strategy, **kw)
        return finish(out.select("event_id", "value", "bucket"))
    return q


def q_clean_dataframe(spark, sf):
    d = fx.dirty_events(spark, sf)
    out = clean.clean_dataframe(
        d, object_config={"case_style": CaseStyle.LOWER, "normalize_spaces": True},
        numeric_config={"columns": ["value", "bucket"], "strategy": FillStrategy.MEDIAN})
    return finish(out)


# ---------------------------------------------------------------- profile
def q_null_counts(spark, sf):
    return profile.null_counts(fx.dirty_events(spark, sf))


def q_bad_value_counts(spark, sf):
    return profile.bad_value_counts(fx.dirty_events(spark, sf))


def q_whitespace_only_counts(spark, sf):
    d = fx.dirty_events(spark, sf).withColumn(
        "note", F.when(F.col("event_id") % 11 == 0, F.lit(" \t ")).otherwise(F.col("label")))
    return profile.whitespace_only_counts(d)


def q_unique_values(spark, sf):
    ev = _t(spark, sf, "events")
    return profile.unique_values(ev, "event_id", ["event_type", "props"])


def q_unique_values_first(spark, sf):
    ev = _t(spark, sf, "events")
    return profile.first_seen_values(ev, "event_id", 50, ["event_type", "props"])


def q_min_max_profile(spark, sf):
    return profile.min_max_profile(_t(spark, sf, "lineitem"))


def q_add_commas(spark, sf):
    from ..functions.text import add_commas
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", add_commas(F.col("o_totalprice")).alias("totalprice_fmt"))


def q_csv_scan(spark, sf):
    """The dirty events written as CSV into the shared folder and read back:
    placeholders become NULL, types are inferred, no row is malformed."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
    (fx.dirty_events(spark, sf).write.option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return finish(csv_scan(spark, path, null_tokens=DEFAULT_MISSING_VALUES, malformed="malformed_row"))


def q_column_info(spark, sf):
    info = profile.column_info(fx.dirty_events(spark, sf), order_col="event_id")
    return info.withColumn("sample", F.array_join("sample", "|", "NULL"))


# ---------------------------------------------------------------- groups
def q_flagship(spark, sf):
    """Clean the dirty events, then group statistics of value by label."""
    d = fx.dirty_events(spark, sf)
    cleaned = clean.clean_object_columns(d, case_style=CaseStyle.LOWER, normalize_spaces=True)
    return finish(groups.group_stats(cleaned, "label", "value"))


def q_group_mean_count_sum(spark, sf):
    # money sums reach 1e9 at sf0.01: compared at cents
    return finish(groups.group_mean_count_sum(_t(spark, sf, "lineitem"), "l_returnflag",
                                              "l_extendedprice"), 2)


def q_group_mean_count_sum_rollup(spark, sf):
    return finish(groups.group_mean_count_sum(_t(spark, sf, "lineitem"), "l_returnflag",
                                              "l_extendedprice", total="rollup"), 2)


def q_group_agg_multi(spark, sf):
    li = _t(spark, sf, "lineitem")
    return finish(groups.group_agg_multi(
        li, "l_linestatus", {"l_quantity": ["sum", "mean", "count"],
                             "l_discount": ["min", "max", "mean"], "l_tax": ["std"]},
        sort_by=("l_quantity", "sum")))


def q_group_stats(spark, sf):
    return finish(groups.group_stats(_t(spark, sf, "lineitem"), "l_returnflag", "l_quantity"))


def q_coefficient_of_variation(spark, sf):
    st = groups.group_stats(_t(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return finish(groups.coefficient_of_variation(st))


def q_anova_f(spark, sf):
    a = groups.anova_oneway(_t(spark, sf, "events"), "event_type", "value")
    return finish(a.drop("p_value", "significant"))


def q_anova_oneway(spark, sf):
    return finish(groups.anova_oneway(_t(spark, sf, "events"), "event_type", "value"))


def q_group_range(spark, sf):
    return finish(groups.group_range(_t(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"))


def q_group_std(spark, sf):
    return finish(groups.group_std(_t(spark, sf, "events"), "event_type", "value"))


def q_group_percentiles(spark, sf):
    return finish(groups.group_percentiles(_t(spark, sf, "lineitem"), "l_returnflag",
                                           "l_extendedprice"))


def q_group_percentiles_events(spark, sf):
    return finish(groups.group_percentiles(_t(spark, sf, "events"), "event_type", "value"))


def q_variance_decomposition(spark, sf):
    return finish(groups.variance_decomposition(_t(spark, sf, "events"), "event_type", "value"))


def q_variance_decomposition_k3(spark, sf):
    return finish(groups.variance_decomposition(_t(spark, sf, "events"), "event_type", "value",
                                                df_groups=3))


QUERIES = {
    "flagship_clean_group_stats": q_flagship,
    "clean_object_columns": q_clean_object_columns,
    "clean_replace_upper_spaces": q_clean_replace_upper_spaces,
    "clean_no_strip_lower": q_clean_no_strip_lower,
    "case_title": q_case_title,
    "fill_mean": _fill(FillStrategy.MEAN),
    "fill_median": _fill(FillStrategy.MEDIAN),
    "fill_mode": _fill(FillStrategy.MODE),
    "fill_zero": _fill(FillStrategy.ZERO),
    "fill_value": _fill(FillStrategy.VALUE, fill_value=-1.0),
    "drop_na_rows": _fill(FillStrategy.DROP),
    "clean_dataframe": q_clean_dataframe,
    "null_counts": q_null_counts,
    "bad_value_counts": q_bad_value_counts,
    "whitespace_only_counts": q_whitespace_only_counts,
    "unique_values": q_unique_values,
    "unique_values_first_seen": q_unique_values_first,
    "min_max_profile": q_min_max_profile,
    "add_commas": q_add_commas,
    "csv_scan": q_csv_scan,
    "column_info": q_column_info,
    "group_mean_count_sum": q_group_mean_count_sum,
    "group_mean_count_sum_rollup": q_group_mean_count_sum_rollup,
    "group_agg_multi": q_group_agg_multi,
    "group_stats": q_group_stats,
    "coefficient_of_variation": q_coefficient_of_variation,
    "anova_f": q_anova_f,
    "anova_oneway": q_anova_oneway,
    "group_range": q_group_range,
    "group_std": q_group_std,
    "group_percentiles": q_group_percentiles,
    "group_percentiles_events": q_group_percentiles_events,
    "variance_decomposition": q_variance_decomposition,
    "variance_decomposition_k3": q_variance_decomposition_k3,
}


# ---------------------------------------------------------------- outliers
def q_analyze_outliers(spark, sf):
    return finish(outliers.analyze_outliers(_t(spark, sf, "lineitem")))


def q_analyze_outliers_wide(spark, sf):
    return finish(outliers.analyze_outliers(_t(spark, sf, "lineitem"), iqr_multiplier=0.5,
                                            include_columns=["l_quantity", "l_extendedprice", "l_tax",
                                                             "l_returnflag"]))


def q_detect_outliers(spark, sf):
    return finish(outliers.detect_outliers(_t(spark, sf, "events"), "value"))


def q_outlier_rows(spark, sf):
    return finish(outliers.outlier_rows(_t(spark, sf, "events"), ["event_id"], ["value", "user_id"]))


def q_boxplot_stats(spark, sf):
    return finish(outliers.boxplot_stats(_t(spark, sf, "events"), "event_type", "value"))


# ---------------------------------------------------------------- correlation
_CORR_FEATURES = ["revol_util", "installment", "dti", "revol_dup", "installment_near", "constant_col"]


def q_corr_matrix(spark, sf):
    return finish(corr.corr_matrix(fx.loans_corr(spark, sf)))


def q_corr_matrix_wide(spark, sf):
    """The dimensions of the embeddings as columns with gaps."""
    e = _t(spark, sf, "embeddings")
    return finish(corr.corr_matrix(e.select(*[F.when((F.col("vec_id") + i) % 7 != 0, F.col("embedding")[i].cast("double")).alias(f"e{i}") for i in range(64)])))


def q_target_correlation(spark, sf):
    return finish(corr.target_correlation(fx.loans_corr(spark, sf), "not_fully_paid"))


def q_high_corr_pairs(spark, sf):
    return finish(corr.high_corr_pairs(fx.loans_corr(spark, sf), 0.7, _CORR_FEATURES))


def q_drop_high_corr(spark, sf):
    lc = fx.loans_corr(spark, sf).drop("loan_id")
    return corr.features_to_drop(lc, "not_fully_paid", 0.7)


# ---------------------------------------------------------------- histograms / plot tables
def q_class_histogram(spark, sf):
    return finish(hist.class_histogram(fx.loans(spark, sf), "not_fully_paid",
                                       ["revol_util", "dti", "inq_last_6mths", "installment"]))


def q_group_histogram(spark, sf):
    return finish(hist.group_histogram(_t(spark, sf, "events"), "event_type", "value"))


def q_group_density_binned(spark, sf):
    return finish(hist.group_density(_t(spark, sf, "events"), "event_type", "value", bins=512))


def q_group_density(spark, sf):
    return finish(hist.group_density(_t(spark, sf, "events"), "event_type", "value"))


def q_category_by_target(spark, sf):
    return hist.category_by_target(fx.loans(spark, sf), "purpose", "not_fully_paid")


# ---------------------------------------------------------------- crosstab / value counts
def q_value_counts_pct(spark, sf):
    return finish(profile.value_counts_pct(fx.loans(spark, sf), "purpose"))


def q_crosstab(spark, sf):
    return profile.crosstab(fx.loans(spark, sf), "purpose", "inq_last_6mths", dense=True)


def q_crosstab_range(spark, sf):
    return profile.crosstab(fx.loans(spark, sf), "inq_last_6mths", "purpose", 2, 6, dense=True)


def q_crosstab_total(spark, sf):
    return profile.crosstab_total(fx.loans(spark, sf), "inq_last_6mths", "purpose", 2, 6)


# ---------------------------------------------------------------- imbalance
_LOAN_LABELS = {0: "Paid", 1: "Default"}


def q_imbalance_classes(spark, sf):
    return finish(imbalance.imbalance_classes(fx.loans(spark, sf), "not_fully_paid", _LOAN_LABELS))


def q_check_imbalance(spark, sf):
    return finish(imbalance.check_imbalance(fx.loans(spark, sf), "not_fully_paid", _LOAN_LABELS))


def q_check_imbalance_toxic(spark, sf):
    return finish(imbalance.check_imbalance(fx.doc_labels(spark, sf), "toxic"))


def q_class_weights(spark, sf):
    return finish(imbalance.class_weights(fx.loans(spark, sf), "not_fully_paid"))


def q_class_weights_quality(spark, sf):
    return finish(imbalance.class_weights(fx.doc_labels(spark, sf), "quality"))


def q_scale_pos_weight(spark, sf):
    return finish(imbalance.scale_pos_weight(fx.loans(spark, sf), "not_fully_paid"))


QUERIES.update({
    "analyze_outliers": q_analyze_outliers,
    "analyze_outliers_selected": q_analyze_outliers_wide,
    "detect_outliers": q_detect_outliers,
    "outlier_rows": q_outlier_rows,
    "boxplot_stats": q_boxplot_stats,
    "corr_matrix": q_corr_matrix,
    "corr_matrix_wide": q_corr_matrix_wide,
    "target_correlation": q_target_correlation,
    "high_corr_pairs": q_high_corr_pairs,
    "drop_high_corr": q_drop_high_corr,
    "class_histogram": q_class_histogram,
    "group_histogram": q_group_histogram,
    "group_density": q_group_density,
    "group_density_binned": q_group_density_binned,
    "category_by_target": q_category_by_target,
    "value_counts_pct": q_value_counts_pct,
    "crosstab": q_crosstab,
    "crosstab_range": q_crosstab_range,
    "crosstab_total": q_crosstab_total,
    "imbalance_classes": q_imbalance_classes,
    "check_imbalance": q_check_imbalance,
    "check_imbalance_toxic": q_check_imbalance_toxic,
    "class_weights": q_class_weights,
    "class_weights_quality": q_class_weights_quality,
    "scale_pos_weight": q_scale_pos_weight,
})


# ---------------------------------------------------------------- metrics over a scored table
def _scored(spark, sf, threshold=0.5):
    return metrics.with_prediction(fx.scored(spark, sf), "score", threshold)


def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored(spark, sf), "label", "prediction")


def q_confusion_matrix_norm(spark, sf):
    cm = metrics.confusion_matrix(_scored(spark, sf), "label", "prediction")
    return finish(metrics.confusion_matrix_norm(cm))


def q_confusion_rates(spark, sf):
    return finish(metrics.confusion_rates(_scored(spark, sf)))


def q_basic_metrics(spark, sf):
    return finish(metrics.basic_metrics(_scored(spark, sf, 0.4)))


def q_classification_report(spark, sf):
    return finish(metrics.classification_report(_scored(spark, sf)))


def q_roc_curve(spark, sf):
    return finish(metrics.roc_curve(fx.scored(spark, sf)))


def q_roc_auc(spark, sf):
    return finish(metrics.roc_auc(fx.scored(spark, sf)))


def q_pr_curve(spark, sf):
    return finish(metrics.pr_curve(fx.scored(spark, sf)))


def q_pr_baseline(spark, sf):
    return finish(metrics.pr_baseline(fx.scored(spark, sf)))


def q_threshold_sweep(spark, sf):
    return finish(metrics.threshold_sweep(fx.scored(spark, sf)))


def q_threshold_sweep_recall_weighted(spark, sf):
    sc = fx.scored(spark, sf)
    auc = metrics.roc_auc_value(sc)
    return finish(metrics.threshold_sweep(sc, metric="recall_weighted", roc_auc=auc,
                                          thresholds=[0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]))


def q_best_threshold(spark, sf):
    return finish(metrics.best_threshold(metrics.threshold_sweep(fx.scored(spark, sf))))


QUERIES.update({
    "confusion_matrix": q_confusion_matrix,
    "confusion_matrix_norm": q_confusion_matrix_norm,
    "confusion_rates": q_confusion_rates,
    "basic_metrics": q_basic_metrics,
    "classification_report": q_classification_report,
    "roc_curve": q_roc_curve,
    "roc_auc": q_roc_auc,
    "pr_curve": q_pr_curve,
    "pr_baseline": q_pr_baseline,
    "threshold_sweep": q_threshold_sweep,
    "threshold_sweep_recall_weighted": q_threshold_sweep_recall_weighted,
    "best_threshold": q_best_threshold,
})


# ---------------------------------------------------------------- features, encoding, split, scaling
LOAN_NAMES = {"revol.util": "revol_util", "inq.last.6mths": "inq_last_6mths", "installment": "installment",
              "log.annual.inc": "log_annual_inc", "days.with.cr.line": "days_with_cr_line", "dti": "dti"}
SCALED = ["revol_util", "inq_last_6mths", "installment", "log_annual_inc", "days_with_cr_line", "dti"]


def q_loan_features(spark, sf):
    return finish(features.create_loan_features(fx.loans(spark, sf), LOAN_NAMES))


def q_one_hot_wide(spark, sf):
    """Part keys as text: thousands of categories; each row's dummy, long form."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return encode.one_hot_index(li, "part", out="dummy")


def q_one_hot(spark, sf):
    return finish(encode.one_hot(fx.loans(spark, sf), ["purpose"]))


def q_stratified_split(spark, sf):
    return split.stratified_split(fx.loans(spark, sf), "loan_id", "not_fully_paid").select("loan_id", "split")


def q_stratified_split_many(spark, sf):
    """Orders split within each customer: thousands of classes."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return split.stratified_split(o, "o_orderkey", "o_custkey").select("o_orderkey", "split")


def q_random_split(spark, sf):
    return split.random_split(fx.loans(spark, sf), "loan_id", 0.25, 0.1, seed=7).select("loan_id", "split")


def q_split_class_distribution(spark, sf):
    sp = split.stratified_split(fx.loans(spark, sf), "loan_id", "not_fully_paid")
    return finish(split.split_class_distribution(sp, "not_fully_paid"))


def q_standard_scale(spark, sf):
    sp = split.stratified_split(fx.loans(spark, sf), "loan_id", "not_fully_paid")
    out, _ = scale.standard_scale(sp, SCALED)
    return finish(out.select("loan_id", "split", *SCALED))


def q_prepare_data(spark, sf):
    lo = fx.loans(spark, sf)
    return finish(preparation.prepare_data(lo, "not_fully_paid", "loan_id").data)


QUERIES.update({
    "loan_features": q_loan_features,
    "one_hot": q_one_hot,
    "one_hot_wide": q_one_hot_wide,
    "stratified_split": q_stratified_split,
    "random_split": q_random_split,
    "stratified_split_many": q_stratified_split_many,
    "split_class_distribution": q_split_class_distribution,
    "standard_scale": q_standard_scale,
    "prepare_data": q_prepare_data,
})


# ---------------------------------------------------------------- neighbours and SMOTE
KNN_FEATURES = ["revol_util", "inq_last_6mths", "installment", "dti"]


def q_knn_self_join(spark, sf):
    lo = fx.loans(spark, sf).where(F.col("not_fully_paid") == 1)
    return finish(neighbors.knn(lo, "loan_id", KNN_FEATURES, k=5))


def _smote(spark, sf, ratio):
    return resample.smote(fx.loans(spark, sf), "loan_id", "not_fully_paid", KNN_FEATURES, ratio=ratio)


def q_smote(spark, sf):
    out = _smote(spark, sf, 0.5)
    return finish(out.select("loan_id", "not_fully_paid", *KNN_FEATURES, "synthetic", "source_key",
                             "neighbor_key", "copy"))


def q_smote_class_counts(spark, sf):
    out = _smote(spark, sf, 0.5)
    return resample.class_distribution(out, "not_fully_paid")


def q_smote_doc_labels(spark, sf):
    dl = fx.doc_labels(spark, sf)
    out = resample.smote(dl, "doc_id", "quality", ["n_chars", "toxic"], ratio=1.0)
    return finish(out.groupBy("quality", "synthetic").agg(F.count(F.lit(1)).alias("count"),
                                                          F.min("n_chars").alias("min_n_chars"),
                                                          F.max("n_chars").alias("max_n_chars")))


QUERIES.update({
    "knn_self_join": q_knn_self_join,
    "smote": q_smote,
    "smote_class_counts": q_smote_class_counts,
    "smote_doc_labels": q_smote_doc_labels,
})


# ---------------------------------------------------------------- training, comparison, selection


def _prepared(spark, sf):
    return preparation.prepare_data(fx.loans(spark, sf), "not_fully_paid", "loan_id")


def q_class_weighted_fit(spark, sf):
    """Logistic regression with balanced class weights, scored on the test rows."""
    p = _prepared(spark, sf)
    cfg = T_.ModelConfig(T_.ModelType.LOGISTIC_REGRESSION, "Logistic Regression", class_weight="balanced")
    res = selection.train_and_evaluate(cfg, p.train, p.test, "not_fully_paid", list(p.feature_names), "loan_id")
    return finish(res.scored)


def q_compare_models(spark, sf):
    p = _prepared(spark, sf)
    configs = T_.default_configs(use_logistic=True, use_gradient_boosting=True)
    table, _ = selection.compare_models(configs, p.train, p.test, "not_fully_paid", list(p.feature_names))
    return finish(table.drop("train_time_s"))


def q_feature_importance(spark, sf):
    p = _prepared(spark, sf)
    cfg = T_.ModelConfig(T_.ModelType.RANDOM_FOREST, "Random Forest", class_weight="balanced")
    res = selection.train_and_evaluate(cfg, p.train, p.test, "not_fully_paid", list(p.feature_names))
    return finish(res.importance)


def q_optimize_strategy(spark, sf):
    p = _prepared(spark, sf)
    table, _ = selection.optimize_strategy(
        lambda: T_.ModelConfig(T_.ModelType.LOGISTIC_REGRESSION, "Logistic Regression"),
        p.train, p.val, "loan_id", "not_fully_paid", list(p.feature_names), smote_ratios=(0.3, 0.5))
    return finish(table.drop("train_time_s"))


def q_training_history(spark, sf):
    """(round, metric, value): loss, accuracy, precision, recall, F1 and AUC of
    every boosting round on the training and the validation rows."""
    p = _prepared(spark, sf)
    cfg = T_.ModelConfig(T_.ModelType.GRADIENT_BOOSTING, "Gradient Boosting",
                         params={"n_estimators": 30, "max_depth": 4, "learning_rate": 0.1, "random_state": 42})
    model, _ = T_.fit(cfg, p.train, list(p.feature_names), "not_fully_paid")
    return finish(staged.fit_history(model, p.train, p.val, list(p.feature_names), "not_fully_paid"))


def q_best_epoch(spark, sf):
    return finish(selection.best_epoch(q_training_history(spark, sf), "val_loss", "min"))


def q_evaluate_model(spark, sf):
    p = _prepared(spark, sf)
    cfg = T_.ModelConfig(T_.ModelType.LOGISTIC_REGRESSION, "Logistic Regression", class_weight="balanced")
    model, _ = T_.fit(cfg, p.train, list(p.feature_names), "not_fully_paid", "balanced")
    ev = evaluation.evaluate_model(model, p.test, list(p.feature_names), "not_fully_paid", "loan_id")
    return finish(evaluation.all_results(ev))


def q_evaluate_scored(spark, sf):
    """The same results for given scores."""
    return finish(evaluation.all_results(evaluation.evaluate_scored(fx.scored(spark, sf), "label", "score")))


def q_selection_summary(spark, sf):
    """The chosen strategy's figures and a row per strategy with its best round."""
    p = _prepared(spark, sf)
    feats = list(p.feature_names)
    table, results = selection.optimize_strategy(
        lambda: T_.ModelConfig(T_.ModelType.XGBOOST, "XGBoost", params={"n_estimators": 10, "max_depth": 3, "learning_rate": 0.3, "random_state": 42}),
        p.train, p.val, "loan_id", "not_fully_paid", feats,
        strategies=["none", "class_weights", "smote_partial"], optimize_for="recall_weighted")
    best = table.orderBy("rank").first()["name"]
    scored = T_.score(results[best].model, p.test, feats, keep=["loan_id", "not_fully_paid"])
    sweep = metrics.threshold_sweep(scored, "not_fully_paid", "probability")
    thr = metrics.best_threshold(sweep).first()["threshold"]
    summary = selection.selection_summary(table, scored, "not_fully_paid", thr, best)
    return finish(selection.all_results(summary, selection.strategy_rows(results, p.val, feats, "not_fully_paid")))


QUERIES.update({
    "class_weighted_fit": q_class_weighted_fit,
    "compare_models": q_compare_models,
    "feature_importance": q_feature_importance,
    "optimize_strategy": q_optimize_strategy,
    "training_history": q_training_history,
    "best_epoch": q_best_epoch,
    "evaluate_model": q_evaluate_model,
    "evaluate_scored": q_evaluate_scored,
    "selection_summary": q_selection_summary,
})


# ---------------------------------------------------------------- streaming


def q_streaming_confusion(spark, sf):
    """Running confusion counts and F1 over the events stream at 0.5."""
    ev = S_.read_table_stream(spark, sf, "events")
    scored = S_.score_stream(fx.scored_of(ev), "score", 0.5)
    return finish(S_.run_available(S_.confusion_counts(scored), "complete"))


def q_streaming_clean(spark, sf):
    """Fill values fitted on the batch table, applied to the event stream."""
    prep = S_.fit_preparation(fx.dirty_events(spark, sf),
                              {"case_style": CaseStyle.LOWER, "normalize_spaces": True},
                              FillStrategy.MEDIAN, ["value", "bucket"])
    stream = fx.dirty_events_of(S_.read_table_stream(spark, sf, "events"))
    return finish(S_.run_available(prep.apply(stream), "append"))


# ---------------------------------------------------------------- missing values, wide fills, histories
def _gaps(spark, sf):
    """Orders with gaps: a bigint beyond 2^53, an int, a double with NaN."""
    k = F.col("o_orderkey")
    return _t(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.when(k % 3 == 1, F.lit(9007199254740993)).when(k % 3 == 2, F.col("o_custkey")).alias("big"),
        F.when(k % 4 != 0, (k % 7).cast("int")).alias("small"),
        F.when(k % 5 == 0, F.lit(float("nan"))).when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"))


def q_fill_mode_bigint(spark, sf):
    return clean.clean_numeric_columns(_gaps(spark, sf), ["big"], FillStrategy.MODE).select("o_orderkey", "big")


def q_fill_value_widen(spark, sf):
    return finish(clean.clean_numeric_columns(_gaps(spark, sf), ["small"], FillStrategy.VALUE, 0.5).select("o_orderkey", "small"))


def q_fill_mean_nan(spark, sf):
    return finish(clean.clean_numeric_columns(_gaps(spark, sf), ["price"], FillStrategy.MEAN).select("o_orderkey", "price"), 4)


def q_group_agg_multi_null_group(spark, sf):
    d = nan_to_null(_gaps(spark, sf)).withColumn("price", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("price")))
    return finish(groups.group_agg_multi(d, "o_orderpriority", {"price": ["sum", "count", "max"]}, total=False))


def _rounds(spark, sf):
    """Each scored row in one of six rounds; odd ids are validation rows."""
    return fx.scored(spark, sf).select("id", "label", "score", (F.col("id") % 6 + 1).alias("round"), (F.col("id") % 5 < 2).alias("is_val"))


def q_metric_history(spark, sf):
    return finish(history.metric_history(_rounds(spark, sf), "label", "score", "round", "is_val"))


def q_early_stop_rounds(spark, sf):
    """Daily mean values per event type as a monitored series."""
    e = _t(spark, sf, "events").groupBy(F.col("event_type").alias("run"), (F.col("event_id") % 60 + 1).alias("round")).agg(F.round(F.avg("value"), 6).alias("value"))
    return finish(history.early_stop(e.withColumn("metric", F.lit("val_f1")), "val_f1", "max", 5, run_cols=["run"]))


QUERIES.update({
    "fill_mode_bigint": q_fill_mode_bigint,
    "fill_value_widen": q_fill_value_widen,
    "fill_mean_nan": q_fill_mean_nan,
    "group_agg_multi_null_group": q_group_agg_multi_null_group,
    "metric_history": q_metric_history,
    "early_stop_rounds": q_early_stop_rounds,
})

QUERIES.update({
    "streaming_confusion_counts": q_streaming_confusion,
    "streaming_clean": q_streaming_clean,
})


# ---------------------------------------------------------------- composites and recipes


def q_anova_for_column(spark, sf):
    """Group statistics, ANOVA, variance decomposition and histogram together."""
    return finish(analysis.all_results(analysis.anova_for_column(_t(spark, sf, "events"), "event_type", "value"), "event_type"))


def q_convert_recipes(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey",
                    convert.to_numeric(F.regexp_replace("o_orderpriority", "[^0-9]", "")).alias("priority_num"),
                    convert.to_numeric(F.col("o_orderpriority")).alias("priority_bad"),
                    convert.to_datetime(F.col("o_orderdate").cast("string")).cast("string").alias("order_ts"),
                    convert.sentinel_to_null(F.col("o_custkey") % 10, [0, 9]).cast("double").alias("cust_digit"))


def q_threshold_cost(spark, sf):
    sweep = metrics.threshold_sweep(fx.scored(spark, sf))
    return finish(metrics.cost_benefit(sweep, lambda t, fn, fp, tp, tn: fn * 500 + fp * 50))


def q_corr_mask_upper(spark, sf):
    return finish(corr.corr_lower_triangle(corr.corr_matrix(fx.loans_corr(spark, sf))))


def q_early_stopping(spark, sf):
    """A boosted fit stopped by its validation AUC, cut at the best round."""
    p = _prepared(spark, sf)
    cfg = T_.ModelConfig(T_.ModelType.GRADIENT_BOOSTING, "Gradient Boosting",
                         params={"n_estimators": 60, "max_depth": 3, "learning_rate": 0.1, "random_state": 42})
    found = staged.fit_until(cfg, p.train, p.val, list(p.feature_names), "not_fully_paid", monitor="val_auc", mode="max", patience=5)
    return finish(spark.range(1).select(
        F.lit("val_auc").alias("monitor"), F.lit("max").alias("mode"), F.lit(5).alias("patience"), F.lit(found.best_round).alias("best_round"),
        F.lit(found.best_value).alias("best_value"), F.lit(found.stop_round).alias("stop_round"), F.lit(found.stopped).alias("stopped"),
        F.lit(found.model.getNumTrees).alias("n_trees")))


def q_score_with_function(spark, sf):
    """A model outside MLlib (here: numpy logistic function with the
    coefficients of a fitted regression) scored batch-wise on the executors."""
    import numpy as np
    p = _prepared(spark, sf)
    feats = list(p.feature_names)
    cfg = T_.ModelConfig(T_.ModelType.LOGISTIC_REGRESSION, "Logistic Regression")
    model, _ = T_.fit(cfg, p.train, feats, "not_fully_paid")
    w, b = np.asarray(model.coefficients.toArray()), float(model.intercept)

    def predict_proba(x):
        return 1.0 / (1.0 + np.exp(-(x @ w + b)))
    return finish(T_.score_with_function(p.test, feats, predict_proba, keep=["loan_id", "not_fully_paid"]))


QUERIES.update({
    "anova_for_column": q_anova_for_column,
    "convert_recipes": q_convert_recipes,
    "threshold_cost": q_threshold_cost,
    "corr_mask_upper": q_corr_mask_upper,
    "early_stopping": q_early_stopping,
    "score_with_function": q_score_with_function,
})



def q_drop_highly_correlated_features(spark, sf):
    """The loans_corr table after correlation pruning (target not_fully_paid)."""
    lc = fx.loans_corr(spark, sf)
    kept, _ = corr.drop_highly_correlated_features(lc.drop("loan_id"), "not_fully_paid", 0.7)
    # long form (loan_id, feature, value) so the check does not depend on
    # knowing the surviving column names in advance
    wide = lc.select("loan_id", *[F.col(n).cast("double").alias(n) for n in kept.columns])
    return finish(wide.unpivot(["loan_id"], kept.columns, "feature", "value"))


def q_train_with_strategy(spark, sf):
    p = _prepared(spark, sf)
    res = selection.train_with_strategy(
        T_.ModelConfig(T_.ModelType.LOGISTIC_REGRESSION, "Logistic Regression"), p.train, p.val, "loan_id",
        "not_fully_paid", list(p.feature_names), "smote_partial+weights", smote_ratio=0.5)
    row = {"strategy": res.strategy, "n_before": res.n_before, "n_after": res.n_after,
           **{f"before_{k}": v for k, v in sorted(res.dist_before.items())},
           **{f"after_{k}": v for k, v in sorted(res.dist_after.items())}, **res.metrics}
    return finish(spark.createDataFrame([row]))  # one row of results


QUERIES.update({
    "drop_highly_correlated_features": q_drop_highly_correlated_features,
    "train_with_strategy": q_train_with_strategy,
})



def q_unique_values_all(spark, sf):
    return profile.distinct_values(_t(spark, sf, "events"), "event_id", ["event_type", "props"])


QUERIES["unique_values_all"] = q_unique_values_all
