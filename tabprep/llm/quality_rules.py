"""Quality rules: fixed base rules, then robust multivariate outliers.

One map-side pass turns every whole text into its counts and a vector of
transformed shares (VECTOR).  For the rows that pass the base rules, the
minimum-covariance-determinant estimate of location and scatter is found per
language and source: from the medians and median deviations, C-steps repeat
"distances, then mean and covariance of the closest ``kept_share`` of the
group" over all rows of the group.  Each step is a grouped aggregate with
map-side partial sums (quantiles by the bounded ``percentile_approx``
sketch), so a hot source costs no more than others.  A row weighs
``n / (n + prior_words)``, as short texts scatter more.  Rows whose weighted
squared Mahalanobis distance, scaled to the median of chi-square, exceeds
``cutoff`` are rejected.

Groups with fewer than ``least_rows`` rows are pooled by language, and those
still smaller over all.  Results: a null text has no words and fails the base
rules; null language or source is a group like others; a row without a
distance (its group has no scatter at all) is kept; an empty table gives an
empty result; repeated rows count as rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .doc_stats import FEATURES, base, features
from .kernels import blocks
from .shared import Scratch, sized

#: Shares that depend little on the language; arcsine of the root evens out their variance.
VECTOR = ("punct_share", "upper_share", "space_share", "top_word_share")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_statistics(documents: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, COUNTS, ``base_failed`` and the vector ``v0``, ``v1``, ..."""
    at = [FEATURES.index(v) for v in VECTOR]
    names = [*keep, *COUNTS, "base_failed", *(f"v{i}" for i in range(len(VECTOR)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            s = base(buf, off)
            x = np.arcsin(np.sqrt(np.clip(features(buf, off, s)[:, at], 0, 1)))
            failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
            yield pa.RecordBatch.from_arrays([*rows.columns[:len(keep)], *(pa.array(s[c].astype(np.int64)) for c in COUNTS), pa.array(failed),
                                              *(pa.array(x[:, i].copy()) for i in range(len(VECTOR)))], names=names)

    fields = documents.select(keep).schema
    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{c} bigint" for c in COUNTS), "base_failed boolean", *(f"v{i} double" for i in range(len(VECTOR)))])
    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(run, out_type)


def _groups(rows: DataFrame, keys: list[str], least_rows: int) -> DataFrame:
    """(keys, grp): the label of the group whose estimate a row uses."""
    count = rows.where("not base_failed").groupBy(*keys).agg(F.count("*").alias("n"))
    by_first = count.groupBy(F.col(keys[0]).alias("k0")).agg(F.sum(F.when(F.col("n") < least_rows, F.col("n"))).alias("m"))
    label = (F.when(F.col("n") >= least_rows, F.to_json(F.struct(F.lit("g").alias("level"), *keys)))
             .when(F.col("m") >= least_rows, F.to_json(F.struct(F.lit("p").alias("level"), keys[0]))).otherwise(F.lit("all")))
    return count.join(by_first, F.col(keys[0]).eqNullSafe(F.col("k0"))).select(*keys, label.alias("grp"))


def _distance(p: int):
    """Weighted squared Mahalanobis distance from columns v*, mu and inv."""
    d = [F.col(f"v{i}") - F.col("mu")[i] for i in range(p)]
    total = F.lit(0.0)
    for i in range(p):
        for j in range(p):
            total = total + d[i] * d[j] * F.col("inv")[i * p + j]
    return F.col("w") * total


def _invert(moments: DataFrame, p: int) -> DataFrame:
    """(grp, mu, inv) from the weighted sums of a group, one row per group."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                n = max(r.sw, 1e-12)
                d = np.array(r.s1) / n
                second = np.zeros((p, p))
                second[np.triu_indices(p)] = np.array(r.s2) / n
                cov = second + np.triu(second, 1).T - np.outer(d, d)
                cov = cov + (1e-9 + 1e-6 * np.trace(cov) / p) * np.eye(p)      # no direction without scatter
                out.append((r.grp, (np.array(r.mu) + d).tolist(), np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(out, columns=["grp", "mu", "inv"])

    return moments.mapInPandas(run, "grp string, mu array<double>, inv array<double>")


def robust_distances(rows: DataFrame, *, keys: list[str], scratch: Scratch, steps: int = 6, kept_share: float = 0.75,
                     prior_words: int = 100, least_rows: int = 30) -> DataFrame:
    """The rows (saved) with ``distance``, null where the base rules fail."""
    p = len(VECTOR)
    group = scratch.save(_groups(rows, keys, least_rows), "groups")
    n_groups = group.count()
    if not n_groups:                                      # no row passes the base rules
        return rows.withColumn("distance", F.lit(None).cast("double"))
    labelled = rows.join(sized(group.select(*(F.col(k).alias(f"__{k}") for k in keys), "grp"), n_groups), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left")
    labelled = labelled.drop(*(f"__{k}" for k in keys)).withColumn("w", F.col("n_words") / (F.col("n_words") + F.lit(float(prior_words))))
    used = labelled.where("not base_failed and grp is not null").select("grp", "w", *(f"v{i}" for i in range(p)))
    middle = used.groupBy("grp").agg(F.array(*(F.percentile_approx(f"v{i}", 0.5, 1000) for i in range(p))).alias("mu"))
    middle = scratch.save(middle, "medians")
    spread = used.join(sized(middle, n_groups), "grp").groupBy("grp").agg(F.first("mu").alias("mu"), F.array(*(F.percentile_approx(F.abs(F.col(f"v{i}") - F.col("mu")[i]), 0.5, 1000) for i in range(p))).alias("mad"))
    inv = F.array(*((1 / F.pow(1.4826 * F.col("mad")[i] + 1e-4, 2) if i == j else F.lit(0.0)) for i in range(p) for j in range(p)))
    params = scratch.save(spread.select("grp", "mu", inv.alias("inv")), "start")
    for _ in range(steps):
        near = used.join(sized(params, n_groups), "grp").withColumn("d2", _distance(p))
        limit = scratch.save(near.groupBy("grp").agg(F.percentile_approx("d2", kept_share, 1000).alias("limit")).join(params, "grp"), "limits")
        d = [F.col(f"v{i}") - F.col("mu")[i] for i in range(p)]
        closest = used.join(sized(limit, n_groups), "grp").where(_distance(p) <= F.col("limit"))
        moments = closest.groupBy("grp").agg(F.first("mu").alias("mu"), F.sum("w").alias("sw"), F.array(*(F.sum(F.col("w") * x) for x in d)).alias("s1"),
                                             F.array(*(F.sum(F.col("w") * d[i] * d[j]) for i in range(p) for j in range(i, p))).alias("s2"))
        params = scratch.save(_invert(moments, p), "params")
    scale = used.join(sized(params, n_groups), "grp").withColumn("d2", _distance(p)).groupBy("grp").agg(F.percentile_approx("d2", 0.5, 1000).alias("mid")).join(params, "grp")
    scale = scratch.save(scale.withColumnRenamed("grp", "__grp"), "scale")
    middle_of_chi2 = p * (1 - 2 / (9 * p)) ** 3
    distance = F.when(~F.col("base_failed") & (F.col("mid") > 0), _distance(p) * F.lit(middle_of_chi2) / F.col("mid"))
    return labelled.join(sized(scale, n_groups), F.col("grp") == F.col("__grp"), "left").withColumn("distance", distance).drop("__grp", "mu", "inv", "mid", "w", "grp")


def judge_quality(documents: DataFrame, *, keep: list[str], keys: tuple[str, str] = ("lang", "source"), text: str = "text", cutoff: float = 100.0, **options) -> DataFrame:
    """The kept columns, COUNTS, ``base_failed``, ``distance`` and ``kept``."""
    scratch = Scratch(documents.sparkSession, "quality-rules")
    extra = [k for k in keys if k not in keep]
    rows = scratch.save(text_statistics(documents, keep=[*keep, *extra], text=text), "statistics")
    out = robust_distances(rows, keys=list(keys), scratch=scratch, **options)
    return out.select(*keep, *COUNTS, "base_failed", (~F.col("base_failed") & ~F.coalesce(F.col("distance") > cutoff, F.lit(False))).alias("kept"), "distance")
