import collections
import random
import re

import numpy as np
from llm_data import documents, empty, prose
from pyspark.sql import functions as F

from tabprep.llm import quality_model, quality_rules, toxicity, trees
from tabprep.llm.training_rows import remainder


def counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), len(lines) - len(set(lines)), len(again)


def test_rules_base_counts(spark):
    df = documents(spark)
    got = quality_rules.judge_quality(df, keep=["doc_id", "text"]).collect()
    assert len(got) == df.count()
    for r in got:
        want = counts(r.text or "")
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge_quality(empty(spark), keep=["doc_id"]).collect() == []


def test_rules_reject_outliers_and_keep_prose(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(60, 300))) for i in range(150)]
    rows += [(1000 + i, "### ".join(prose(rng, 120).split(" "))) for i in range(8)] + [(2000 + i, prose(rng, 120).upper()) for i in range(8)]
    df = documents(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    got = {r.doc_id: r for r in quality_rules.judge_quality(df, keep=["doc_id"]).collect()}
    assert not any(got[i].kept for i in got if i >= 1000)
    assert sum(got[i].kept for i in range(150)) >= 148


def test_rules_estimate_near_numpy(spark):
    """The distances of one group follow an estimate made by numpy C-steps."""
    rng = random.Random(6)
    df = documents(spark, [(i, prose(rng, rng.randint(80, 200))) for i in range(200)]).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))
    rows = quality_rules.text_statistics(df, keep=["doc_id"]).toPandas()
    got = quality_rules.judge_quality(df, keep=["doc_id"]).toPandas().set_index("doc_id").distance
    x, n = rows[[f"v{i}" for i in range(4)]].to_numpy()[~rows.base_failed], rows.n_words.to_numpy()[~rows.base_failed]
    w, mu = n / (n + 100), np.median(x, 0)
    inv = np.diag(1 / (1.4826 * np.median(abs(x - mu), 0) + 1e-4) ** 2)
    for _ in range(6):
        d = w * np.einsum("ij,jk,ik->i", x - mu, inv, x - mu)
        near = d <= np.quantile(d, 0.75)
        mu = np.average(x[near], axis=0, weights=w[near])
        cov = ((x[near] - mu) * w[near][:, None]).T @ (x[near] - mu) / w[near].sum()
        inv = np.linalg.inv(cov + (1e-9 + 1e-6 * np.trace(cov) / 4) * np.eye(4))         # no capitals here: one share has no scatter
    d = w * np.einsum("ij,jk,ik->i", x - mu, inv, x - mu)
    d *= 4 * (1 - 2 / 36) ** 3 / np.median(d)
    assert np.corrcoef(d, got.loc[rows.doc_id[~rows.base_failed]])[0, 1] > 0.98


def labelled(spark, n=400):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(n):
        bad, rude = i % 4 == 0, i % 5 == 0
        t = prose(rng, rng.randint(60, 200))
        t = "### ".join(t.split(" ")) if bad else t
        if rude:
            t += " idiot" + rng.choice(["", "s", "ic"]) + " " + prose(rng, 10)
        if i % 3 == 0:
            t += " women "
        rows.append((i, t))
        marks.append((i, int(not bad), int(rude)))
    return documents(spark, rows), spark.createDataFrame([*marks, (None, 1, 0), (n + 5, None, None)], "doc_id bigint, quality int, toxic int"), marks


def test_quality_held_out(spark):
    df, labels, marks = labelled(spark)
    scored = {r.doc_id: r for r in quality_model.score_quality(df, quality_model.fit_quality(df, labels), keep=["doc_id"]).collect()}
    assert all(0 <= r.score <= 1 for r in scored.values())
    held = [r.doc_id for r in df.where(remainder("doc_id", 4) == 2).select("doc_id").collect()]
    assert np.mean([scored[i].predicted == marks[i][1] for i in held]) > 0.95
    good = quality_model.keep_good(df, quality_model.fit_quality(df, labels))
    assert good.schema == df.schema
    assert {r.doc_id for r in good.collect()} == {i for i, r in scored.items() if r.score >= 0.7}


def test_models_without_labels_or_rows(spark):
    df, none = documents(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_model.score_quality(df, quality_model.fit_quality(df, none), keep=["doc_id"]).collect()} == {0.5}
    assert {r.score for r in toxicity.score_toxicity(df, toxicity.fit_toxicity(df, none), keep=["doc_id"]).collect()} == {0.5}
    _, labels, _ = labelled(spark, 20)
    assert quality_model.score_quality(empty(spark), quality_model.fit_quality(empty(spark), labels), keep=["doc_id"]).collect() == []
    assert toxicity.score_toxicity(empty(spark), toxicity.fit_toxicity(empty(spark), labels), keep=["doc_id"]).collect() == []


def test_scores_of_awkward_rows(spark):
    df, labels, _ = labelled(spark, 100)
    every = documents(spark)
    assert quality_model.score_quality(every, quality_model.fit_quality(df, labels), keep=["doc_id"]).where("score is null").count() == 0
    out = toxicity.score_toxicity(every, toxicity.fit_toxicity(df, labels), keep=["doc_id"])
    assert out.count() == every.count() and out.where("score is null").count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = trees.fit(x[:2000], y[:2000], depth=3)
    assert ((model.probability(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    # flat traversal equals walking one row at a time
    for row in x[2000:2020]:
        m = model.start
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            m += leaf[k - len(f)]
        assert np.isclose(model.margin(row[None, :])[0], m)


def test_toxicity_held_out(spark):
    df, labels, marks = labelled(spark)
    scored = {r.doc_id: r for r in toxicity.score_toxicity(df, toxicity.fit_toxicity(df, labels), keep=["doc_id"]).collect()}
    held = [r.doc_id for r in df.where(remainder("doc_id", 5) == 0).select("doc_id").collect()]
    assert np.mean([scored[i].predicted == marks[i][2] for i in held]) > 0.95


def test_counterfactual_penalty_closes_the_gap():
    """Labels go with one group's name; the penalty takes that back."""
    rng = random.Random(8)
    rows, y = [], []
    for i in range(400):
        rude = i % 2
        rows.append(f"{prose(rng, 12)} {'idiot' if rude else 'friend'} {'muslims' if rude and i % 4 else 'christians'}")
        y.append(rude)
    raw = [r.encode() for r in rows]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, cut = toxicity.word_ids(np.frombuffer(b"".join(raw), np.uint8), off, 20)
    lists = [ids[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]

    def gap(model):
        def score(t):
            b = t.encode()
            return float(model.score(np.frombuffer(b, np.uint8), np.array([0, len(b)], np.int64))[0])
        return abs(score("the muslims eat bread") - score("the christians eat bread"))

    free, tied = (toxicity.fit(lists, np.array(y, float), penalty=p) for p in (0.0, 10.0))
    assert gap(tied) < 0.5 * gap(free)

