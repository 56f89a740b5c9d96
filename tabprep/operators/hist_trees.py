"""Boosted trees and forests of large tables, grown from histograms.

MLlib keeps an object per row, for a forest with a count for every tree, and
walks each row through the tree one value at a time.  Here the rows are
blocks of bytes, one code per feature (small features share a byte), and a
level of a tree is a few numpy steps over a block.  What is learnt is what
MLlib learns: the same thresholds rule (``maxBins`` bins of equal weight, read
off a draw of the rows), all features (boosting) or a draw of their root per
node (forest) tried at every node, the same gains, least leaf and pruning;
boosting on the log loss with the first tree at full weight.  The outcome is
an MLlib model like any other: its nodes are saved in MLlib's format and
loaded.

Blocks are cached on the executors and spill to their disks; boosting adds
each tree to the rows' margins in a new cached version, and every
``_KEEP_EVERY`` rounds one goes to the checkpoint folder.  A forest's
bootstrap counts come from the seed, the tree and the block, so they are drawn
again at every level instead of being kept.  Histograms are added up by task,
a forest's by tree in the reducers; the driver gets the nodes.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.columns import c
from ..session import ensure_checkpoint_dir

#: Rows of a block and, at most, of a task's part of the table.
BLOCK_ROWS, TASK_ROWS = 1 << 15, 4_000_000
#: Bytes of histograms that one pass of a forest makes in a task, and rows that it holds meanwhile.
PASS_BYTES, HELD_ROWS = 64 << 20, 4_000_000
#: Task results that the driver adds up itself; more are added up in so many groups first.
GROUPS = 32
#: Rows scored at once.
SCORED_ROWS = 1 << 18
MAX_DEPTH = 12
_KEEP_EVERY = 10
_CODES = 256
_OFTEN = 4                                            # more rows than this come of 4 draws in 1,000


# ------------------------------------------------------------------ bins
def cuts_of(values: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds of a feature as MLlib sets them: midway between values, at
    most ``bins - 1``, each where the weight so far is closest to a multiple of
    an equal share."""
    distinct, at = np.unique(values + 0.0, return_inverse=True)
    mids = (distinct[:-1] + distinct[1:]) / 2
    if len(mids) <= bins - 1:
        return mids
    total = np.cumsum(np.bincount(at, weights=weight))
    stride = total[-1] / bins
    target, found = stride, []
    for k in range(1, len(distinct)):
        if abs(total[k - 1] - target) < abs(total[k] - target):
            found.append(mids[k - 1])
            target += stride
    return np.array(found)


@dataclass(frozen=True)
class Layout:
    """Where each feature's bin is: ``cols[j]`` lists the features of byte j of
    a row, the first varying fastest."""
    cuts: tuple[np.ndarray, ...]
    cols: tuple[tuple[int, ...], ...]

    @property
    def sizes(self) -> list[int]:
        return [math.prod(len(self.cuts[f]) + 1 for f in col) for col in self.cols]

    def place(self, f: int) -> tuple[int, int, int]:
        """(byte, step, bins) of a feature: its bin is code // step % bins."""
        j = next(j for j, col in enumerate(self.cols) if f in col)
        before = self.cols[j][:self.cols[j].index(f)]
        return j, math.prod(len(self.cuts[k]) + 1 for k in before), len(self.cuts[f]) + 1

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Rows x features -> bytes x rows; a value at a threshold is below it."""
        out = np.zeros((len(self.cols), len(x)), np.uint8)
        for j, col in enumerate(self.cols):
            step = 1
            for f in col:
                out[j] += (np.searchsorted(self.cuts[f], x[:, f], side="left") * step).astype(np.uint8)
                step *= len(self.cuts[f]) + 1
        return out


def layout_of(cuts: Sequence[np.ndarray]) -> Layout:
    """Features of few bins share a byte."""
    cols: list[list[int]] = []
    room = 0
    for f in sorted((f for f in range(len(cuts)) if len(cuts[f])), key=lambda f: (len(cuts[f]), f)):
        bins = len(cuts[f]) + 1
        if bins > room:
            cols.append([])
            room = _CODES
        cols[-1].append(f)
        room //= bins
    return Layout(tuple(cuts), tuple(map(tuple, cols)))


# ------------------------------------------------------------------ nodes
@dataclass(slots=True)
class Node:
    path: int                                         # 1 for the root, then 2 p and 2 p + 1
    feature: int = -1
    cut: int = -1
    gain: float = -1.0
    impurity: float = 0.0
    stats: tuple[float, ...] = ()
    raw: int = 0
    prediction: float = 0.0
    left: Node | None = None
    right: Node | None = None


@dataclass
class Tree:
    root: Node = field(default_factory=lambda: Node(1))
    levels: list = field(default_factory=list)        # steps that lead rows to the open nodes
    open: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.open = [self.root]

    def split(self, layout: Layout, found: list[tuple], last: bool) -> None:
        """Give the open nodes what was found of them and open their children."""
        steps, children = [], []
        for node, (own, best) in zip(self.open, found):
            node.stats, node.raw, node.impurity, node.prediction = own
            steps.append((-1, -1, -1, -1))
            if best is None:
                continue
            node.feature, node.cut, node.gain, *sides = best
            node.left, node.right = Node(2 * node.path), Node(2 * node.path + 1)
            for child, side in zip((node.left, node.right), sides):
                child.stats, child.raw, child.impurity, child.prediction = side
            if not last:
                steps[-1] = (node.feature, node.cut, len(children), len(children) + 1)
                children += [node.left, node.right]
        if children:
            # rows of finished nodes gather in the slot after the last
            self.levels.append(np.where(np.array([*steps, (-1, -1, -1, -1)])[:, 2:3] < 0, [-1, -1, len(children), len(children)], [*steps, (-1, -1, -1, -1)]))
        self.open = children

    def leaves(self) -> tuple[list, list]:
        """Steps that lead rows to the leaves, and the leaves."""
        levels, at = [], [self.root]
        while any(n.left for n in at):
            steps, after = [], []
            for n in at:
                steps.append((n.feature, n.cut, len(after), len(after) + 1) if n.left else (-1, -1, len(after), len(after)))
                after += [n.left, n.right] if n.left else [n]
            levels.append(np.array(steps))
            at = after
        return levels, at


def tables(layout: Layout, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte to look at, next slot by code) of every slot of a level, from its
    steps (feature or -1, cut, slot below, slot above)."""
    place = np.array([layout.place(f) if len(cuts) else (0, 1, 1) for f, cuts in enumerate(layout.cuts)] + [(0, 1, 1)])[steps[:, 0]]
    above = np.arange(_CODES) // place[:, 1:2] % place[:, 2:] > steps[:, 1:2]
    return place[:, 0], np.where(above & (steps[:, :1] >= 0), steps[:, 3:], steps[:, 2:3]).ravel()


def walk(x: np.ndarray, levels: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Slot of each row after the levels; ``x`` is bytes x rows."""
    n = x.shape[1]
    flat, row, slot = x.ravel(), np.arange(n), None
    for byte, table in levels:
        if slot is None:
            slot = table[x[byte[0]]]
        else:
            at = (byte * n)[slot]
            at += row
            slot <<= 8
            slot += flat[at]
            slot = table[slot]
    return np.zeros(n, np.int64) if slot is None else slot


# ------------------------------------------------------------------ histograms
def _slices(sizes: Sequence[int], slots: int) -> list[slice]:
    ends = np.cumsum([0, *(2 * (slots + 1) * s for s in sizes)])
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]


def add_histograms(out: list[np.ndarray], x: np.ndarray, slot: np.ndarray, y: np.ndarray, sizes: Sequence[int], slots: int,
                   weights: Sequence[np.ndarray | None]) -> None:
    """Adds to each of ``out`` the sums of one weight (None: rows) by byte,
    slot, class and code."""
    base = slot * 2
    base += y
    at: dict[int, np.ndarray] = {}
    for j, (size, own) in enumerate(zip(sizes, _slices(sizes, slots))):
        if size not in at:
            at[size] = base * size
        index = at[size] + x[j]
        for total, weight in zip(out, weights):
            if len(total) > own.start:
                total[own] += np.bincount(index, weights=weight, minlength=own.stop - own.start)


def by_feature(layout: Layout, total: np.ndarray, slots: int) -> Iterator[tuple[int, np.ndarray]]:
    """(feature, slots x classes x bins)."""
    for j, (size, own) in enumerate(zip(layout.sizes, _slices(layout.sizes, slots))):
        if own.start >= len(total):
            return
        codes = total[own].reshape(slots + 1, 2, size)[:slots]
        for f in layout.cols[j]:
            _, unit, bins = layout.place(f)
            yield f, codes.reshape(slots, 2, -1, bins, unit).sum(axis=(2, 4))


def _best(layout: Layout, slots: int, count: np.ndarray, score, least: int, allowed: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(gain, feature, cut) of the best split of each slot, the first feature
    and cut among equals; gain 0 where there is none.  ``score(feature)`` gives
    the cuts' gains; a side has ``least`` rows at least."""
    gain, feature, cut = np.zeros(slots), np.full(slots, -1), np.full(slots, -1)
    raw = {f: c.sum(axis=1) for f, c in by_feature(layout, count, slots)}
    for f in sorted(raw):
        left = np.cumsum(raw[f], axis=1)[:, :-1]
        right = raw[f].sum(axis=1, keepdims=True) - left
        own = np.where((left >= least) & (right >= least), score(f), 0.0)
        if allowed is not None:
            own[~allowed[:, f]] = 0.0
        k = own.argmax(axis=1)
        best = own[np.arange(slots), k]
        better = best > gain
        gain[better], feature[better], cut[better] = best[better], f, k[better]
    return gain, feature, cut


def _gains(parts: Sequence[tuple[np.ndarray, np.ndarray]], weight: np.ndarray) -> np.ndarray:
    """Impurity less the sides' impurities, of ``parts`` [(sums, their totals)]
    over ``weight`` (slots x bins): the squares' sums cancel out."""
    total = weight.sum(axis=1, keepdims=True)
    wl = np.cumsum(weight, axis=1)[:, :-1]
    wr = total - wl
    with np.errstate(divide="ignore", invalid="ignore"):
        after, before = np.zeros_like(wl), np.zeros_like(total)
        for s in parts:
            all_ = s.sum(axis=1, keepdims=True)
            sl = np.cumsum(s, axis=1)[:, :-1]
            after += sl * sl / wl + (all_ - sl) ** 2 / wr
            before += all_ * all_ / total
        gain = (after - before) / total
        return np.where(np.isfinite(gain) & (after - before > 1e-14 * after), gain, 0.0)


def split_variance(layout: Layout, slots: int, count: np.ndarray, total: np.ndarray, squares: np.ndarray, class_weight: np.ndarray,
                   least: int) -> list[tuple]:
    """What ``Tree.split`` takes: each node's own figures and its best split
    with the sides' figures.  ``squares`` may hold the first byte alone."""
    counts, sums, sq = (dict(by_feature(layout, h, slots)) for h in (count, total, squares))
    w = class_weight[None, :, None]
    weighted = {f: (c * w).sum(axis=1) for f, c in counts.items()}
    summed = {f: (s * w).sum(axis=1) for f, s in sums.items()}
    squared = {f: (s * w).sum(axis=1) for f, s in sq.items()}
    gain, feature, cut = _best(layout, slots, count, lambda f: _gains([summed[f]], weighted[f]), least, None)

    def figures(k: int, f: int, of: slice) -> tuple:
        n, s, raw = weighted[f][k, of].sum(), summed[f][k, of].sum(), int(counts[f][k, :, of].sum())
        q = squared[f][k, of].sum() if f in squared else s * s / n
        return (float(n), float(s), float(q)), raw, float((q - s * s / n) / n), float(s / n)

    first, out = next(iter(squared)), []
    for k in range(slots):
        f, c = int(feature[k]), int(cut[k])
        out.append((figures(k, first, slice(None)), (f, c, float(gain[k]), figures(k, f, slice(c + 1)), figures(k, f, slice(c + 1, None))) if f >= 0 else None))
    return out


def split_gini(layout: Layout, slots: int, count: np.ndarray, class_weight: np.ndarray, least: int, allowed: np.ndarray | None) -> list[tuple]:
    counts = dict(by_feature(layout, count, slots))
    w = class_weight[None, :, None]
    weighted = {f: c * w for f, c in counts.items()}
    gain, feature, cut = _best(layout, slots, count, lambda f: _gains([weighted[f][:, 0], weighted[f][:, 1]], weighted[f].sum(axis=1)), least, allowed)

    def figures(k: int, f: int, of: slice) -> tuple:
        own, raw = weighted[f][k, :, of].sum(axis=1), int(counts[f][k, :, of].sum())
        n = own.sum()
        return tuple(map(float, own)), raw, float(1 - ((own / n) ** 2).sum()) if n else 0.0, float(own.argmax())

    first, out = next(iter(counts)), []
    for k in range(slots):
        f, c = int(feature[k]), int(cut[k])
        out.append((figures(k, first, slice(None)), (f, c, float(gain[k]), figures(k, f, slice(c + 1)), figures(k, f, slice(c + 1, None))) if f >= 0 else None))
    return out


# ------------------------------------------------------------------ blocks of rows
def blocks_of(data: DataFrame, layout: Layout, features_col: str, label_col: str, rows: int) -> RDD:
    """(block's number, labels, codes, margins) with margins empty; a block's
    number tells its part of the table too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            y, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1)
            return pa.RecordBatch.from_arrays([pa.array([y.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["y", "x"])

        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(k, BLOCK_ROWS)
                if size and size + part.num_rows > BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                held.append((part.column(1).to_numpy().astype(np.uint8), layout.codes(x)))
                size += part.num_rows
        if size:
            yield block()

    cores = data.sparkSession.sparkContext.defaultParallelism
    parts = data.select(vector_to_array(features_col).alias("x"), F.col(label_col).alias("y")).coalesce(cores * math.ceil(rows / (cores * TASK_ROWS)))
    return parts.mapInArrow(run, "y binary, x binary").rdd.mapPartitionsWithIndex(
        lambda p, got: (((p, k), bytes(r[0]), bytes(r[1]), b"") for k, r in enumerate(got)))


def _read(block: tuple, width: int) -> tuple[np.ndarray, np.ndarray]:
    y = np.frombuffer(block[1], np.uint8)
    return y, np.frombuffer(block[2], np.uint8).reshape(width, len(y))


def _target(block: tuple, y: np.ndarray) -> np.ndarray:
    """What a round's tree is fitted to: the signs, then the negative gradients
    4 s / (1 + exp(2 s margin))."""
    sign = y * 2.0 - 1
    if not block[3]:
        return sign
    with np.errstate(over="ignore"):
        return 4 * sign / (1 + np.exp(2 * sign * np.frombuffer(block[3])))


def added_up(parts: RDD, tasks: int, groups: int = GROUPS) -> list[np.ndarray]:
    """Sum of the tasks' arrays [(task, arrays)], in the order of the tasks;
    more than ``groups`` are added up in so many groups first."""
    def added(got) -> list[np.ndarray]:
        out = None
        for _, arrays in sorted(got, key=lambda g: g[0]):
            out = [a + b for a, b in zip(out, arrays)] if out else arrays
        return out

    while tasks > groups:
        size = max(2, -(-tasks // groups))
        parts, tasks = parts.map(lambda g, size=size: (g[0] // size, g)).groupByKey(-(-tasks // size)).mapValues(added), -(-tasks // size)
    return added(parts.collect())


# ------------------------------------------------------------------ boosting
def boost(blocks: RDD, layout: Layout, class_weight: np.ndarray, rounds: int, depth: int, rate: float, least: int = 1) -> list[Tree]:
    sizes, width = layout.sizes, len(layout.cols)
    tasks, trees = blocks.getNumPartitions(), []
    state, kept = blocks.persist(StorageLevel.MEMORY_AND_DISK), None

    def level(levels: list, slots: int, last: bool, counted: bool):
        def run(got) -> Iterator[tuple]:
            ends, lead = [s.stop for s in _slices(sizes, slots)], [tables(layout, s) for s in levels]
            out = [np.zeros(0 if counted else ends[-1]), np.zeros(ends[-1]), np.zeros(ends[-1] if last else ends[0])]
            for block in got:
                y, x = _read(block, width)
                target = _target(block, y)
                add_histograms(out, x, walk(x, lead), y, sizes, slots, (None, target, target * target))
            yield TaskContext.get().partitionId(), out
        return run

    def advance(tree: Tree, weight: float):
        levels, nodes = tree.leaves()
        values = np.array([n.prediction * weight for n in nodes])

        def run(got) -> Iterator[tuple]:
            lead = [tables(layout, s) for s in levels]
            for block in got:
                _, x = _read(block, width)
                step = values[walk(x, lead)]
                yield (*block[:3], (np.frombuffer(block[3]) + step if block[3] else step).tobytes())
        return run

    old = whole = None                                # the counts at the root are those of the first round
    for k in range(rounds):
        tree = Tree()
        for at in range(depth):
            counted = at == 0 and whole is not None
            found = added_up(state.mapPartitions(level(tree.levels, len(tree.open), at + 1 == depth, counted)), tasks)
            if counted:
                found[0] = whole
            whole = found[0] if whole is None else whole
            if old is not None:                       # the new margins are cached by now
                old.unpersist()
                old = None
                if state.isCheckpointed():
                    kept = _dropped(state, kept)
            tree.split(layout, split_variance(layout, len(tree.open), *found, class_weight, least), at + 1 == depth)
            if not tree.open:
                break
        trees.append(tree)
        if k + 1 < rounds:
            old, state = state, state.mapPartitions(advance(tree, rate if k else 1.0), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
            if (k + 1) % _KEEP_EVERY == 0:
                state.checkpoint()
    state.unpersist()
    if kept:
        _dropped(state, kept)
    return trees


def _dropped(state: RDD, kept: str | None) -> str | None:
    """Deletes the checkpoint before; the path of the present one."""
    if kept:
        path = state.ctx._jvm.org.apache.hadoop.fs.Path(kept)
        path.getFileSystem(state.ctx._jsc.hadoopConfiguration()).delete(path, True)
    return state.getCheckpointFile()


# ------------------------------------------------------------------ forest
def _poisson_edges() -> np.ndarray:
    """Where 32 random bits give one more row, of a Poisson law of mean 1."""
    p = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(14)])
    return np.unique(np.minimum(np.floor(p * 2.0 ** 32), 2.0 ** 32 - 1)).astype(np.uint32)


_EDGES = _poisson_edges()


def bootstrap(seed: int, tree: int, block: tuple[int, int], n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bootstrap draw."""
    bits = np.random.Generator(np.random.SFC64((seed, tree, *block))).integers(0, 2 ** 32, n, dtype=np.uint32)
    out = (bits >= _EDGES[0]).view(np.uint8)
    for edge in _EDGES[1:_OFTEN]:
        out += bits >= edge
    rare = np.flatnonzero(bits >= _EDGES[_OFTEN])
    out[rare] = np.searchsorted(_EDGES, bits[rare], side="right")
    return out.astype(float)


def _allowed(seed: int, tree: int, paths: Sequence[int], features: int, tried: int) -> np.ndarray:
    """The features that each node may split on."""
    out = np.zeros((len(paths), features), bool)
    for k, path in enumerate(paths):
        out[k, np.random.default_rng((seed, tree, path)).choice(features, tried, replace=False)] = True
    return out


def forest(blocks: RDD, layout: Layout, class_weight: np.ndarray, count: int, depth: int, least: int, tried: int, seed: int) -> list[Tree]:
    sizes, width, features = layout.sizes, len(layout.cols), len(layout.cuts)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    ctx, trees = blocks.ctx, [Tree() for _ in range(count)]

    def grown(shared):
        def histograms(got) -> Iterator[tuple]:
            held, size = [], 0

            def counted() -> Iterator[tuple]:
                for t, (levels, paths) in shared.value.items():
                    slots, lead = len(paths), [tables(layout, s) for s in levels]
                    out = [np.zeros(_slices(sizes, slots)[-1].stop)]
                    for block in held:
                        y, x = _read(block, width)
                        add_histograms(out, x, walk(x, lead), y, sizes, slots, (bootstrap(seed, t, block[0], len(y)),))
                    yield t, out[0].astype(np.int32)  # of at most HELD_ROWS rows

            for block in got:
                held.append(block)
                size += len(block[1])
                if size >= HELD_ROWS:
                    yield from counted()
                    held, size = [], 0
            if held:
                yield from counted()
        return histograms

    def best(shared):
        def run(found: tuple[int, np.ndarray]) -> tuple[int, list]:
            t, total = found
            paths = shared.value[t][1]
            return t, split_gini(layout, len(paths), total, class_weight, least, _allowed(seed, t, paths, features, tried))
        return run

    for at in range(depth):
        todo = [t for t in range(count) if trees[t].open]
        while todo:
            own, room = [], PASS_BYTES
            while todo and (not own or room > 0):
                own.append(todo.pop(0))
                room -= 4 * _slices(sizes, len(trees[own[-1]].open))[-1].stop
            shared = ctx.broadcast({t: (trees[t].levels, [n.path for n in trees[t].open]) for t in own})
            sums = blocks.mapPartitions(grown(shared)).reduceByKey(lambda a, b: a.astype(np.int64) + b, min(len(own), ctx.defaultParallelism))
            for t, found in sums.map(best(shared)).collect():
                trees[t].split(layout, found, at + 1 == depth)
            shared.unpersist()
    blocks.unpersist()
    return trees


# ------------------------------------------------------------------ scores
@dataclass(frozen=True)
class Grown:
    """Trees ready to score rows: steps to the leaves and what these add."""
    layout: Layout
    steps: tuple[tuple[np.ndarray, ...], ...]
    values: tuple[np.ndarray, ...]
    boosted: bool

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of the positive class, for rows x features."""
        blocks = [self.layout.codes(x[k:k + BLOCK_ROWS]) for k in range(0, len(x), BLOCK_ROWS)]
        total = np.zeros(len(x))
        for steps, values in zip(self.steps, self.values):
            lead = [tables(self.layout, s) for s in steps]
            for k, block in enumerate(blocks):
                total[k * BLOCK_ROWS:k * BLOCK_ROWS + block.shape[1]] += values[walk(block, lead)]
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-2 * total)) if self.boosted else total / len(self.steps)


def scored(grown: Grown, df: DataFrame, features_col: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns and ``probability``; row-local."""
    shared = df.sparkSession.sparkContext.broadcast(grown)      # bounded by the model
    names = [*keep, "probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            p, at = shared.value.probability(np.concatenate([b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for b in held])), 0
            for b in held:
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p[at:at + b.num_rows])], names=names)
                at += b.num_rows

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= SCORED_ROWS:
                    yield from done()
                    held = []
        if held:
            yield from done()

    return df.select(vector_to_array(features_col).alias("__x"), *[c(k) for k in keep]).mapInArrow(
        run, StructType([*(df.schema[k] for k in keep), StructField("probability", DoubleType())]))


# ------------------------------------------------------------------ MLlib's model
def _nodes(tree: Tree, layout: Layout) -> list[tuple]:
    """(id, prediction, impurity, stats, rows, gain, left, right, feature,
    threshold) of a tree in MLlib's order; two leaves of one prediction become
    one, as in MLlib."""
    def pruned(n: Node) -> bool:                      # True: a leaf
        if n.left is None:
            return True
        a, b = pruned(n.left), pruned(n.right)
        if a and b and n.left.prediction == n.right.prediction:
            n.left = n.right = None
            return True
        return False

    rows: list = []

    def put(n: Node) -> int:
        k = len(rows)
        rows.append(None)
        if n.left is None:
            rows[k] = (k, n.prediction, n.impurity, n.stats, n.raw, -1.0, -1, -1, -1, None)
        else:
            a, b = put(n.left), put(n.right)
            rows[k] = (k, n.prediction, n.impurity, n.stats, n.raw, n.gain, a, b, n.feature, float(layout.cuts[n.feature][n.cut]))
        return k

    pruned(tree.root)
    put(tree.root)
    return rows


_NODE = """struct(cast(id as int) as id, prediction, impurity, impurityStats, rawCount, gain, cast(leftChild as int) as leftChild, cast(rightChild as int) as rightChild,
           struct(cast(featureIndex as int) as featureIndex, filter(array(threshold), t -> t is not null) as leftCategoriesOrThreshold, -1 as numCategories) as split) as nodeData"""
_NAMES = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "featureIndex", "threshold")


def as_mllib(spark: SparkSession, est: Estimator, trees: list[Tree], layout: Layout, weights: Sequence[float]) -> Model:
    """The model of ``est`` with these trees, saved in the shared folder in
    MLlib's format and loaded; ``grown`` scores rows as it does."""
    boosted = isinstance(est, GBTClassifier)
    model = GBTClassificationModel if boosted else RandomForestClassificationModel
    meta = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    params = lambda of: {p.name: v for p, v in of.items()}
    whole = meta | {"class": f"org.apache.spark.ml.classification.{model.__name__}", "uid": est.uid, "paramMap": params(est._paramMap),
                    "defaultParamMap": params(est._defaultParamMap), "numFeatures": len(layout.cuts), "numTrees": len(trees)} | ({} if boosted else {"numClasses": 2})
    one = meta | {"class": f"org.apache.spark.ml.{'regression.DecisionTreeRegressionModel' if boosted else 'classification.DecisionTreeClassificationModel'}",
                  "paramMap": {"maxDepth": est.getMaxDepth()}, "defaultParamMap": {}}
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    types = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
    batches, steps, values = [], [], []
    for t, weight in enumerate(weights):              # a tree's nodes as objects go once they are written down
        tree, trees[t] = trees[t], None
        rows = [(t, *row) for row in _nodes(tree, layout)]
        batches.append(pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=["treeID", *_NAMES]))
        levels, nodes = tree.leaves()                 # of the pruned tree
        steps.append(tuple(s.astype(np.int32) for s in levels))
        values.append(np.array([n.prediction * weight if boosted else n.stats[1] / sum(n.stats) for n in nodes]))
    table = pa.Table.from_batches(batches)
    spark.createDataFrame(table).selectExpr("treeID", _NODE).coalesce(1).write.parquet(f"{path}/data")
    spark.createDataFrame([(t, json.dumps(one | {"uid": f"{'dtr' if boosted else 'dtc'}_{uuid.uuid4().hex[:12]}"}), float(w)) for t, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    try:
        out = model.load(path)
        out.grown = Grown(layout, tuple(steps), tuple(values), boosted)
        return out
    finally:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# ------------------------------------------------------------------ fits
def fits(est: Estimator) -> bool:
    """Whether ``fit`` grows what this estimator asks for."""
    if not isinstance(est, (GBTClassifier, RandomForestClassifier)) or not 1 <= est.getMaxDepth() <= MAX_DEPTH or est.getMaxBins() > _CODES:
        return False
    plain = est.getSubsamplingRate() == 1.0 and est.getMinInfoGain() == 0.0 and est.getMinWeightFractionPerNode() == 0.0
    if isinstance(est, GBTClassifier):
        return plain and est.getFeatureSubsetStrategy() == "all" and not est.isDefined(est.validationIndicatorCol)
    return plain and est.getFeatureSubsetStrategy() == "auto" and est.getBootstrap() and est.getNumTrees() > 1


def fit(est: Estimator, data: DataFrame, rows: int, weights: Sequence[float] = (1.0, 1.0)) -> Model | None:
    """``est`` fitted on ``data`` (a vector column, labels 0 and 1) with a
    weight per class.  None where no feature has two values."""
    spark, bins, seed = data.sparkSession, min(est.getMaxBins(), rows), est.getSeed()
    weight = np.array(weights, float)
    # MLlib's rule: thresholds come from so many rows
    share = min(1.0, max(bins * bins, 10_000) / rows)
    drawn = data.sample(share, seed) if share < 1 else data
    got = drawn.select(vector_to_array(est.getFeaturesCol()), est.getLabelCol()).collect()
    if not got:
        return None
    x, of = np.array([g[0] for g in got], float), weight[np.array([int(g[1]) for g in got])]
    del got
    layout = layout_of([cuts_of(x[:, f], of, bins) for f in range(x.shape[1])])
    if not layout.cols:
        return None
    ensure_checkpoint_dir(spark)
    blocks = blocks_of(data, layout, est.getFeaturesCol(), est.getLabelCol(), rows)
    if isinstance(est, GBTClassifier):
        trees = boost(blocks, layout, weight, est.getMaxIter(), est.getMaxDepth(), est.getStepSize(), est.getMinInstancesPerNode())
        return as_mllib(spark, est, trees, layout, [1.0] + [est.getStepSize()] * (len(trees) - 1))
    trees = forest(blocks, layout, weight, est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode(), math.ceil(math.sqrt(x.shape[1])), seed)
    return as_mllib(spark, est, trees, layout, [1.0] * len(trees))
