"""Raw table -> encoded -> split -> scaled: the training-ready table.

One DataFrame carries every row with a ``split`` column instead of six
separate arrays; the fitted category lists and scaler travel with it so the
same transformation can be applied to new (or streaming) data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns
from ..operators.encode import categories, one_hot
from ..operators.scale import ScalerModel, fit_standard_scaler
from ..operators.split import stratified_split
from ..functions.columns import string_columns
from ..session import ensure_checkpoint_dir

#: Tables of up to so many rows stay in the partitions they come in.
SMALL_ROWS = 250_000
#: Rows of a partition at most, beyond which every core gets several.
TASK_ROWS = 2_000_000


@dataclass(frozen=True)
class PreparedData:
    data: DataFrame                 # key, features..., target, split
    encoded_df: DataFrame           # after one-hot, before split and scaling
    feature_names: tuple[str, ...]
    target_col: str
    key_col: str
    categories: dict
    scaler: ScalerModel | None

    def part(self, name: str) -> DataFrame:
        return self.data.where(F.col("split") == F.lit(name))

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def val(self) -> DataFrame:
        return self.part("val")

    @property
    def test(self) -> DataFrame:
        return self.part("test")


def spread(data: DataFrame, rows: int) -> DataFrame:
    """Rows dealt evenly over all cores.  A scan of narrow columns gives few
    and uneven partitions, by bytes, where a fit's work goes by rows.  Each
    core gets the same number of partitions: a forest sends its statistics
    once per partition, so there are no more than the rows call for."""
    if rows <= SMALL_ROWS:
        return data
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data.repartition(cores * math.ceil(rows / (cores * TASK_ROWS)))


def prepare_data(df: DataFrame, target_col: str, key_col: str,
                 categorical_cols: Sequence[str] | None = None, test_size: float = 0.3,
                 val_size: float = 0.2, scale_features: bool = True, random_state: int = 42,
                 stratify: bool = True, materialize: bool = True) -> PreparedData:
    """Encode the categorical columns (first category dropped), split
    (exact stratified quotas, reproducible per key), and scale the features
    on the training rows.  The key column is carried along but is not a
    feature."""
    cols = list(categorical_cols) if categorical_cols is not None else \
        [n for n in string_columns(df) if n != target_col]
    cats = categories(df, cols)
    encoded = one_hot(df, cols, target_col, cats=cats) if cols else df
    if target_col not in encoded.columns:
        raise ValueError(f"Target column '{target_col}' not found in dataframe")
    features = [n for n in encoded.columns if n not in (target_col, key_col)]
    split = stratified_split(encoded, key_col, target_col if stratify else None, test_size, val_size,
                             random_state)
    scaler = None
    data = split
    if scale_features:
        scaler = fit_standard_scaler(split.where(F.col("split") == "train"),
                                     numeric_columns(split, features))
        data = scaler.transform(split)
    data = data.select(c(key_col), *[c(f) for f in features], c(target_col), "split")
    if materialize:
        # every fit and report reads this table many times: cut the lineage
        # (split windows, joins, scaler) once, in the shared checkpoint folder
        ensure_checkpoint_dir(df.sparkSession)
        data = spread(data, df.count()).checkpoint()
    return PreparedData(data, encoded, tuple(features), target_col, key_col, cats, scaler)
