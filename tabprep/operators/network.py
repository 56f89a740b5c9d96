"""A small feed-forward classifier trained data-parallel.

MLlib's perceptron knows neither row weights nor dropout nor a learning rate
for its optimiser; here all three count.  The model (hidden layers of
rectified units, one logistic output) is small, so every task gets all of it:

* with ``batch_size`` each task runs Adam steps over mini-batches of its own
  rows, and after each epoch the tasks' parameters and moments are averaged in
  proportion to their rows' weights (parameter mixing);
* without it an epoch is one Adam step on the weighted gradient of all rows,
  which tasks add up.  A row of weight 2 then counts exactly as two rows.

Each task returns its sums as one row; rows of many tasks are added up in
groups before the driver adds the groups, so it receives a number of model
copies that does not grow with the data.  Rows are read from a saved table of
fixed order, and random numbers come from the seed, the epoch and the
partition, so a task that is repeated elsewhere gives the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save_table
from .hist_trees import added_up

#: Task results that the driver adds up itself; more are added up in so many groups first.
GROUPS = 32
_BETAS, _TINY, _CLIP = (0.9, 0.999), 1e-7, 1e-7


def shapes(sizes: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:]))


def unpack(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(weights, biases) of each layer, views into one array."""
    out, at = [], 0
    for a, b in shapes(sizes):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def initial(sizes: Sequence[int], seed: int) -> np.ndarray:
    rng, flat = np.random.default_rng(seed), np.zeros(sum(a * b + b for a, b in shapes(sizes)))
    for w, _ in unpack(flat, sizes):
        w[:] = rng.normal(0, np.sqrt(2 / w.shape[0]), w.shape)
    return flat


def forward(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> np.ndarray:
    """Probability of the positive class of each row."""
    layers = unpack(flat, sizes)
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0)
    w, b = layers[-1]
    return 0.5 * (1 + np.tanh(0.5 * (x @ w + b)[:, 0]))


def gradient(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray, weight: np.ndarray,
             dropout: float = 0.0, rng: np.random.Generator | None = None) -> tuple[np.ndarray, float]:
    """Gradient of the weighted sum of cross-entropies, and that sum."""
    layers, inputs = unpack(flat, sizes), [x]
    drop = dropout if rng is not None else 0.0
    for w, b in layers[:-1]:
        h = inputs[-1] @ w
        h += b
        np.maximum(h, 0, out=h)
        if drop:
            h *= rng.random(h.shape) >= drop
            h *= 1 / (1 - drop)
        inputs.append(h)
    w, b = layers[-1]
    p = (inputs[-1] @ w)[:, 0]
    p += b
    p *= 0.5
    np.tanh(p, out=p)
    p += 1
    p *= 0.5
    sure = np.clip(p, _CLIP, 1 - _CLIP)
    loss = -float((weight * (y * np.log(sure) + (1 - y) * np.log(1 - sure))).sum())
    out = np.empty_like(flat)
    p -= y
    p *= weight
    grads, error = unpack(out, sizes), p[:, None]
    for k in range(len(layers) - 1, -1, -1):
        np.matmul(inputs[k].T, error, out=grads[k][0])
        np.add.reduce(error, axis=0, out=grads[k][1])
        if k:
            error = error @ layers[k][0].T
            error *= inputs[k] > 0                    # neither cut off nor dropped
            if drop:
                error *= 1 / (1 - drop)
    return out, loss


def adam(flat: np.ndarray, m: np.ndarray, v: np.ndarray, g: np.ndarray, step: int, rate: float) -> None:
    """One step, in place."""
    change = g - m
    change *= 1 - _BETAS[0]
    m += change
    np.multiply(g, g, out=change)
    change -= v
    change *= 1 - _BETAS[1]
    v += change
    scale = v / (1 - _BETAS[1] ** step)
    np.sqrt(scale, out=scale)
    scale += _TINY
    np.divide(m, 1 - _BETAS[0] ** step, out=change)
    change *= rate
    change /= scale
    flat -= change


@dataclass
class NetworkModel:
    """``transform`` adds ``probability`` (a vector, as MLlib's classifiers do)."""
    flat: np.ndarray
    sizes: tuple[int, ...]
    features_col: str
    losses: tuple[float, ...]                         # mean training loss of each epoch

    def transform(self, df: DataFrame) -> DataFrame:
        flat, sizes = self.flat, self.sizes

        @F.pandas_udf("array<double>")
        def predict(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            p = forward(flat, sizes, np.stack(x.to_list()).astype(float))
            return pd.Series(list(np.stack([1 - p, p], 1)))

        return df.withColumn("probability", array_to_vector(predict(vector_to_array(self.features_col))))


@dataclass
class NetworkClassifier:
    hidden: tuple[int, ...] = (32, 16)
    epochs: int = 50
    learning_rate: float = 0.001
    dropout_rate: float = 0.0
    batch_size: int | None = 256
    seed: int = 42
    features_col: str = "features"
    label_col: str = "label"
    weight_col: str | None = None

    def __post_init__(self) -> None:
        if not 0 <= self.dropout_rate < 1 or self.learning_rate <= 0 or self.epochs < 1 or any(h < 1 for h in self.hidden) or (self.batch_size is not None and self.batch_size < 1):
            raise ValueError("dropout_rate must be in [0, 1), learning_rate, epochs, layer and batch sizes above 0")

    def setWeightCol(self, name: str) -> NetworkClassifier:  # noqa: N802 (as MLlib's estimators)
        self.weight_col = name
        return self

    def fit(self, df: DataFrame) -> NetworkModel:
        spark = df.sparkSession
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        rows = save_table(df.select(vector_to_array(self.features_col).alias("x"), F.col(self.label_col).cast("double").alias("y"), weight.alias("w")).where("w > 0"), "network-rows")
        first = rows.first()
        if first is None:
            raise ValueError("no rows of positive weight to fit on")
        sizes = (len(first["x"]), *self.hidden, 1)
        flat = initial(sizes, self.seed)
        m, v, step, losses = np.zeros_like(flat), np.zeros_like(flat), 0, []
        # every epoch reads all rows: as blocks of bytes, in the same tasks and batches
        blocks = rows.mapInArrow(_packed, "x binary, y binary, w binary").rdd.map(lambda r: tuple(map(bytes, r))).persist(StorageLevel.DISK_ONLY)
        tasks = blocks.getNumPartitions()
        for epoch in range(self.epochs):
            shared = spark.sparkContext.broadcast((flat, m, v, step))
            total, = added_up(blocks.mapPartitions(self._epoch(shared, sizes, epoch)), tasks, GROUPS)
            size, n, loss, steps = len(flat), total[0], total[1], total[2]
            losses.append(loss / n)
            if self.batch_size is None:
                step += 1
                adam(flat := flat.copy(), m := m.copy(), v := v.copy(), total[3:3 + size] / n, step, self.learning_rate)
            else:
                flat, m, v = (total[3 + k * size:3 + (k + 1) * size] / n for k in range(3))
                step += int(round(steps / n))
            shared.unpersist()
        blocks.unpersist()
        return NetworkModel(flat, sizes, self.features_col, tuple(losses))

    def _epoch(self, shared, sizes: tuple[int, ...], epoch: int):
        batch, rate, dropout, seed = self.batch_size, self.learning_rate, self.dropout_rate, self.seed

        def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
            """Sum of weights, of losses and of steps times weights; then the
            gradient, or parameters and moments times weights."""
            flat, m, v, step = (np.copy(s) for s in shared.value)
            task = TaskContext.get().partitionId()
            rng = np.random.default_rng((seed, epoch, task))
            n = loss = 0.0
            taken, grad, begun = 0, np.zeros_like(flat), int(step)
            for block in blocks:
                x, y, w = map(np.frombuffer, block)
                size, x = len(y), x.reshape(len(y), -1) if len(y) else np.zeros((0, sizes[0]))
                if batch:
                    order = rng.permutation(size)
                    x, y, w = x[order], y[order], w[order]
                for k in range(0, size, batch or 8192):
                    own = slice(k, k + (batch or 8192))
                    g, lost = gradient(flat, sizes, x[own], y[own], w[own], dropout, rng)
                    n, loss = n + w[own].sum(), loss + lost
                    if batch:
                        taken += 1
                        adam(flat, m, v, g / w[own].sum(), begun + taken, rate)
                    else:
                        grad += g
            tail = [flat * n, m * n, v * n] if batch else [grad]
            yield task, [np.concatenate([[n, loss, taken * n], *tail])]

        return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y, w = b.column(0).flatten(), b.column(1), b.column(2)
        yield pa.RecordBatch.from_arrays([pa.array([v.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for v in (x, y, w)], names=["x", "y", "w"])
