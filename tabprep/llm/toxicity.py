"""Toxicity scores with a counterfactual penalty.

A linear model on the distinct words and word beginnings of a text
(lower-cased, hashed to ``2 ** bits`` buckets), fitted by proximal gradient steps on a bounded,
documented sample of labelled rows (``sample_rows``).  For each sampled text
counterfactuals are made: an identity term found in it is swapped for another
term of its group, and a text without one gets a term of a group inserted
against another of the same group.  The loss adds ``penalty`` times the mean
squared change of the logit, so naming a group does not move the score.  The L1 term
keeps weights of ordinary words at zero, hence long texts do not drift.

The fitted weights are one short array; every whole text is scored in one
map-side pass.  Language, source, ids and labels are no inputs of a score.

Results: a null or empty text has no words and gets the model's base score;
without usable labels every score is the smoothed share of label 1 (0.5
without any label); an empty table gives an empty result; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import LOWER, SpanHash, blocks, distinct_per_row, mix, words
from .training_rows import labelled_sample

#: Groups of terms that may stand for one another; a parameter of the fit.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("black", "white", "asian", "latino"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"), ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "natives", "refugees"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("schwarze", "weiße"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos"),
)

#: Lengths of word beginnings, in bytes.
STEMS = (4, 5, 6)

_EDGE = np.zeros(256, bool)                      # letters, digits and all bytes beyond ASCII make words here
_EDGE[[b for b in range(256) if b >= 0x80 or chr(b).isalnum()]] = True


def word_ids(buf: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashed words and word beginnings (STEMS bytes, of longer
    words) of each row, and the row offsets.  Beginnings stand for inflected forms."""
    low = LOWER[buf]
    clean = np.where(_EDGE[low], low, np.uint8(32))
    start, end, row = words(clean, off)
    hashed = SpanHash(clean)
    value, of = [hashed(start, end)], [np.arange(len(start))]
    for n in STEMS:
        long = np.flatnonzero(end - start > n)
        value.append(mix(hashed(start[long], start[long] + n) + np.uint64(n)))
        of.append(long)
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    value = np.concatenate(value)[order] >> np.uint64(64 - bits)
    return distinct_per_row(value, row[of[order]], len(off) - 1)


def features_of(term: str, bits: int) -> np.ndarray:
    """All features of a term: the word and its beginnings."""
    raw = term.lower().encode()
    return word_ids(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), bits)[0].astype(np.int64)


def ids_of(terms: list[str], bits: int) -> np.ndarray:
    """The hashed word of each term, as ``word_ids`` makes it."""
    raw = [t.lower().encode() for t in terms]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    buf = np.frombuffer(b"".join(raw), np.uint8)
    return SpanHash(buf)(off[:-1], off[1:]) >> np.uint64(64 - bits)


@dataclass
class ToxicModel:
    weight: np.ndarray        # one per bucket
    bias: float
    bits: int

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        ids, cut = word_ids(buf, off, self.bits)
        total = np.concatenate([[0.0], np.cumsum(self.weight[ids.astype(np.int64)])])
        logit = self.bias + total[cut[1:]] - total[cut[:-1]]
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def fit(rows: list[np.ndarray], y: np.ndarray, *, bits: int = 20, terms=IDENTITY_TERMS, penalty: float = 1.0, l1: float = 2e-4,
        steps: int = 200, least_rows: int = 3) -> ToxicModel:
    """rows: hashed distinct words of each labelled text.

    The smooth part is the logistic loss plus ``penalty`` times the mean of
    (logit change)² over the counterfactuals; accelerated proximal steps."""
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    weight = np.zeros(1 << bits)
    if not len(y) or y.min() == y.max():
        return ToxicModel(weight, float(np.log(prior / (1 - prior))), bits)
    groups = [np.unique(ids_of(list(g), bits)).astype(np.int64) for g in terms]
    member = {int(i): k for k, g in enumerate(groups) for i in g}
    parts = {int(ids_of([t], bits)[0]): features_of(t, bits) for g in terms for t in g}
    flat = np.concatenate(rows).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, n = np.unique(flat, return_counts=True)
    used = np.union1d(used[n >= least_rows], np.concatenate([*parts.values(), np.zeros(0, np.int64)]))
    col = np.searchsorted(used, flat)
    known = (col < len(used)) & (used[np.minimum(col, len(used) - 1)] == flat)
    col, owner = col[known], owner[known]
    # counterfactuals: the features of the term taken out and of the one put in
    out_, in_ = [], []
    for i, r in enumerate(rows):
        found = [int(w) for w in r if int(w) in member]
        if found:
            swaps = [(w, groups[member[w]]) for w in found]
        else:
            g = groups[i % len(groups)]
            swaps = [(int(g[i // len(groups) % len(g)]), g)]
        for w, g in swaps:
            other = g[g != w]
            if len(other):
                out_.append(w)
                in_.append(int(other[i % len(other)]))
    sides = []
    for side in (out_, in_):
        size = [len(parts[t]) for t in side]
        sides.append((np.repeat(np.arange(len(side)), size), np.searchsorted(used, np.concatenate([parts[t] for t in side]) if side else np.zeros(0, np.int64))))
    (out_pair, out_col), (in_pair, in_col) = sides
    w, wide = np.zeros(len(used)), len(used)
    bias = float(np.log(prior / (1 - prior)))
    z, zb, t = w.copy(), bias, 1.0
    # a bound on the curvature: a few rows hold many words, so scale each column by its share of rows
    share = np.bincount(col, minlength=wide) / len(y)
    longest = max(1.0, float(np.bincount(owner, minlength=len(y)).mean()))
    pairs = np.bincount(np.concatenate([out_col, in_col]), minlength=wide) / max(len(out_), 1)
    rate = 1.0 / (0.25 * np.sqrt(share * longest) + 16 * penalty * pairs + 1e-3)
    rate = np.minimum(rate, 40.0)
    for _ in range(steps):
        logit = zb + np.bincount(owner, z[col], len(y))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        grad = np.bincount(col, error[owner], wide)
        if len(out_):
            change = np.bincount(out_pair, z[out_col], len(out_)) - np.bincount(in_pair, z[in_col], len(in_))
            change *= 2 * penalty / len(out_)
            grad += np.bincount(out_col, change[out_pair], wide) - np.bincount(in_col, change[in_pair], wide)
        new = z - rate * grad
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        new_b = zb - 1.0 * error.sum()
        if ((z - new) * (new - w)).sum() + (zb - new_b) * (new_b - bias) > 0:     # restart the momentum
            t = 1.0
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, zb = new + (t - 1) / later * (new - w), new_b + (t - 1) / later * (new_b - bias)
        w, bias, t = new, new_b, later
    weight[used] = w
    return ToxicModel(weight, float(bias), bits)


def fit_toxicity(documents: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 5, held_out: int = 0, sample_rows: int = 8_000,
                 id_col: str = "doc_id", text: str = "text", bits: int = 20, **options) -> ToxicModel:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            ids, cut = word_ids(buf, off, bits)
            ids = ids.astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()), rows.column(1)], names=["x", "y"])

    sample = labelled_sample(documents, labels, label, folds=folds, held_out=held_out, rows=sample_rows, id_col=id_col, text=text)
    # equal word sets with equal labels (copies) count once
    got = sorted({(bytes(r.x), r.y) for r in sample.mapInArrow(measure, "x binary, y int").toLocalIterator()})
    return fit([np.frombuffer(x, np.int32) for x, _ in got], np.array([y for _, y in got], float), bits=bits, **options)


def score_toxicity(documents: DataFrame, model: ToxicModel, *, keep: list[str], text: str = "text", score: str = "score", at_least: float = 0.5) -> DataFrame:
    """The kept columns, ``score`` (0 to 1, higher is more toxic) and ``predicted``."""
    fields = documents.select(keep).schema
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            p = shared.value.score(buf, off)
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(p), pa.array((p >= at_least).astype(np.int32))], names=[*keep, score, "predicted"])

    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"{score} double, predicted int"])
    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(run, out_type)
