"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sized


def remainder(column: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, *, folds: int, held_out: int, rows: int,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``rows`` labelled ids outside the held-out
    fold, chosen by a hash of the id; the same rows on every run."""
    chosen = (labels.select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("__label"))
              .where("__id is not null and __label in (0, 1)").where(remainder("__id", folds) != held_out)
              .groupBy("__id").agg(F.max("__label").alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(rows))
    return documents.select(F.col(id_col).alias("__id"), F.col(text).alias("__text")).join(sized(chosen, rows), "__id").select("__text", "__label")
