"""A corpus pipeline over ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns the next docs; ``run``
writes every stage's rows as Parquet in the shared folder and reads them
back, so a lost executor costs at most one stage.  Every stage works on all
rows that the one before kept, and all but the last keep the columns of
``documents``:

1. quality: rows that the quality classifier rejects go;
2. near duplicates: one row of each group stays;
3. decontamination: rows that hold a benchmark item go;
4. secrets: spans of secrets are replaced by ``[SECRET]``, ``n_chars`` follows;
5. pieces: the text becomes ``n_tokens``, ``token_ids`` and ``decoded``.

The models of stages 1 and 4 are fitted on the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabprep.llm import decontaminate, near_dup, pieces, quality_model, secret_scan
from tabprep.llm.queries import tokenizer
from tabprep.llm.shared import Scratch
from tabprep.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep_good(docs, quality_model.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, secret_scan.fit_field(docs), length="n_chars" if "n_chars" in docs.columns else None)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = {"text", "n_tokens", "token_ids", "decoded"}
    return pieces.encode_decode(docs, tokenizer("piece_bpe_32k.model"), keep=[c for c in docs.columns if c.lower() not in made])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("sentence_pieces", sentence_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
