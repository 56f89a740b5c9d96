"""Quality scores: histogram gradient-boosted trees over document statistics.

The statistics of a bounded, documented sample of labelled rows
(``sample_rows``) reach the driver as a matrix of ``len(FEATURES)`` numbers a
row, where the trees are fitted; the flat trees are broadcast and every text
is scored in one map-side pass.  Language, source, ids and labels are no
inputs of a score.

Results: a null or empty text has all statistics zero and is scored like any
other; without usable labels every score is 0.5; ids without a label are
scored too; an empty table gives an empty result; repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import trees
from .doc_stats import FEATURES, features
from .kernels import blocks
from .training_rows import labelled_sample


def fit_quality(documents: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 4, held_out: int = 2,
                sample_rows: int = 12_000, id_col: str = "doc_id", text: str = "text") -> trees.FlatTrees:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in features(buf, off)], pa.binary()), rows.column(1)], names=["x", "y"])

    sample = labelled_sample(documents, labels, label, folds=folds, held_out=held_out, rows=sample_rows, id_col=id_col, text=text)
    got = sorted((bytes(r.x), r.y) for r in sample.mapInArrow(measure, "x binary, y int").collect())
    x = np.array([np.frombuffer(a) for a, _ in got]).reshape(len(got), len(FEATURES))
    return trees.fit(x, np.array([y for _, y in got], float))


def score_quality(documents: DataFrame, model: trees.FlatTrees, *, keep: list[str], text: str = "text", score: str = "score",
                  at_least: float = 0.7) -> DataFrame:
    """The kept columns, ``score`` (0 to 1, higher is better) and ``predicted``."""
    fields = documents.select(keep).schema
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            p = shared.value.probability(features(buf, off))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(p), pa.array((p >= at_least).astype(np.int32))], names=[*keep, score, "predicted"])

    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"{score} double, predicted int"])
    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(run, out_type)


def keep_good(documents: DataFrame, model: trees.FlatTrees, *, text: str = "text", at_least: float = 0.7) -> DataFrame:
    """The rows whose text scores ``at_least``, all columns as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, text):
            yield rows.filter(pa.array(shared.value.probability(features(buf, off)) >= at_least))

    return documents.mapInArrow(run, documents.schema)
