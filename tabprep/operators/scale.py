"""Standard scaling fitted on the training rows only.

``(x - mean) / std`` with the **population** standard deviation (ddof 0);
a constant column is divided by 1.  MLlib's ``StandardScaler`` uses the
sample deviation, so the fit is an ordinary aggregate instead.  The fitted
parameters are two literals per column, so ``transform`` is row-local and
valid on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, numeric_columns


@dataclass(frozen=True)
class ScalerModel:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        params = {n: (m, s) for n, m, s in zip(self.columns, self.means, self.stds)}
        return df.select([
            ((c(n).cast("double") - F.lit(params[n][0])) / F.lit(params[n][1])).alias(n)
            if n in params else c(n) for n in df.columns])


def fit_standard_scaler(df: DataFrame, columns: Sequence[str] | None = None,
                        exclude: Sequence[str] | None = None) -> ScalerModel:
    names = numeric_columns(df, columns, exclude)
    if not names:
        return ScalerModel((), (), ())
    row = df.agg(*[F.struct(F.avg(c(n)).alias("m"), F.stddev_pop(c(n)).alias("s")).alias(f"_{i}")
                   for i, n in enumerate(names)]).first()
    means, stds = [], []
    for i in range(len(names)):
        m, s = row[f"_{i}"]["m"], row[f"_{i}"]["s"]
        means.append(0.0 if m is None else float(m))
        stds.append(1.0 if not s else float(s))  # constant (or empty) column: divide by 1
    return ScalerModel(tuple(names), tuple(means), tuple(stds))


def standard_scale(df: DataFrame, columns: Sequence[str] | None = None, split_col: str | None = "split",
                   fit_on: str = "train", exclude: Sequence[str] | None = None) -> tuple[DataFrame, ScalerModel]:
    """Fit on rows with ``split_col == fit_on`` (all rows if ``split_col``
    is None) and apply to every row."""
    fit_rows = df.where(c(split_col) == F.lit(fit_on)) if split_col else df
    model = fit_standard_scaler(fit_rows, columns, exclude)
    return model.transform(df), model
