"""Exact k-nearest neighbours within one table, without a cross join.

For every point v we need the k points w != v closest in Euclidean distance
(ties by id).  The points are dealt into a tree of cells: a cell of more than
LEAF_ROWS points gets up to FANOUT of its points as pivots and each point goes
to its nearest pivot, again and again until cells are small.  Of each node the
driver knows the pivot, the number of points and the radius U.

1. Within its own leaf every point finds k others; the k-th distance is its
   ``reach``: no neighbour is beyond it.
2. With it the point walks down the tree.  By the triangle inequality a node
   can hold one of its neighbours only if ``dist(v, pivot) <= reach + U``, so
   it meets the pivots on its way, not those of all cells, and is sent to the
   few leaves it arrives at.
3. A leaf compares its points with the queries sent to it and keeps the k
   nearest of each; the last step keeps the k nearest over all leaves.

A leaf's points are cut into blocks of BLOCK_ROWS, and queries are read as a
stream of Arrow batches, so neither a large leaf nor many queries are ever
collected, and no pair of points beyond the k nearest of a block is a row.

The tree is broadcast and bounded by TREE_BYTES, so leaves are larger where
there are more than about 10^7 points of ten features.  The work depends on
the data: where distances concentrate (many independent dimensions) the bounds
exclude little and points visit most leaves.  ``knn_distinct`` needs distinct
vectors; ``knn`` collapses repeated vectors first and maps the answer back to
rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c
from ..session import save_table

BLOCK_ROWS = 1024
LEAF_ROWS = 64
FANOUT = 64
TREE_BYTES = 64 << 20
LEVELS = 24


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, summed feature by feature (the order SQL adds in)."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j][:, None] - b[:, j][None, :]) ** 2
    return np.sqrt(total)


def _best(row, dist, ids, k):
    """The k smallest (dist, id) of each row, as positions; rows ascending."""
    _, code = np.unique(ids, return_inverse=True)
    order = np.lexsort((code, dist, row))
    first = np.concatenate([[True], row[order][1:] != row[order][:-1]]) if len(order) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[place < k]


@dataclass
class PivotTree:
    """Nodes side by side, the children of a node next to one another; node 0
    is the root and has no pivot."""
    centre: np.ndarray                 # nodes x features
    first: np.ndarray                  # first child, of nodes that are split
    many: np.ndarray                   # children, 0 for leaves
    size: np.ndarray
    radius: np.ndarray

    def grow(self, centres: dict[int, np.ndarray]) -> None:
        """The children of each node, by their centres; all nodes at once, for
        one copy of the arrays."""
        count = np.array([len(x) for x in centres.values()], np.int64)
        nodes = np.fromiter(centres, np.int64, len(centres))
        self.first[nodes], self.many[nodes] = len(self.size) + np.cumsum(count) - count, count
        none = np.zeros(int(count.sum()), np.int64)
        self.centre = np.concatenate([self.centre, *centres.values()])
        self.first, self.many, self.size = (np.concatenate([old, none]) for old in (self.first, self.many, self.size))
        self.radius = np.concatenate([self.radius, np.zeros(len(none))])

    def children(self, node: int) -> slice:
        return slice(int(self.first[node]), int(self.first[node] + self.many[node]))

    def leaves_within(self, x: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of x) where the leaf may hold points within the rows' reach."""
        limit = np.where(self.size > 0, self.radius, -np.inf)
        walk = [(0, np.arange(len(x)))]
        while walk:
            node, rows = walk.pop()
            if not self.many[node]:
                yield node, rows
                continue
            own = self.children(node)
            near = _distances(x[rows], self.centre[own]) <= reach[rows][:, None] + limit[own]
            walk += [(own.start + j, rows[near[:, j]]) for j in np.flatnonzero(near.any(0)).tolist()]


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, d = np.empty(len(x), np.int64), np.empty(len(x))
    for k in range(0, len(x), 1024):
        all_ = _distances(x[k:k + 1024], centres)
        at[k:k + 1024] = all_.argmin(1)
        d[k:k + 1024] = all_[np.arange(len(all_)), at[k:k + 1024]]
    return at, d


def _dealt(rows: DataFrame, to: dict[int, tuple[np.ndarray, np.ndarray]], dim: int) -> DataFrame:
    """Rows (id, vec, cell, d) with those of the cells in ``to`` moved to the
    nearest of the cell's (new cell ids, centres)."""
    shared = rows.sparkSession.sparkContext.broadcast(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, d = batch.column(2).to_numpy().copy(), batch.column(3).to_numpy().copy()
            x, old = _matrix(batch.column(1), dim), cell.copy()
            for node in np.unique(old).tolist():
                if node in shared.value:
                    ids, centres = shared.value[node]
                    own = np.flatnonzero(old == node)
                    at, d[own] = _nearest(x[own], centres)
                    cell[own] = ids[at]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(d, pa.float64())], names=["id", "vec", "cell", "d"])

    return rows.mapInArrow(run, rows.schema)


def _stats(rows: DataFrame, tree: PivotTree) -> None:
    found = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("u")).toArrow()   # a row per leaf, as columns
    cell, n, u = (found.column(j).to_numpy() for j in range(3))
    # a hair of slack for rounding
    tree.size[cell], tree.radius[cell] = n, np.where(cell > 0, u * (1 + 1e-9) + 1e-12, np.inf)


def pivot_tree(rows: DataFrame, dim: int, n: int, least: int, seed: int, fanout: int, leaf: int) -> tuple[DataFrame, PivotTree]:
    """Split the root (all rows in cell 0) into cells of about half of ``leaf``
    points, and cells of more than twice ``leaf`` again; (rows in their leaves, tree).  Children of fewer than ``least``
    points are given up and their points go to the next pivot."""
    tree = PivotTree(np.zeros((1, dim)), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([n]), np.array([np.inf]))
    open_ = [0] if n > 2 * leaf and fanout > 1 else []
    for level in range(LEVELS):
        want = {node: min(fanout, -(-2 * int(tree.size[node]) // leaf)) for node in open_}
        if not open_ or (len(tree.size) + 2 * sum(want.values())) * (8 * dim + 32) > TREE_BYTES:
            break
        shares = rows.sparkSession.createDataFrame(pa.table({"cell": pa.array(list(want), pa.int32()), "share": [m / int(tree.size[node]) for node, m in want.items()]}))
        drawn = (F.xxhash64("id", F.lit(seed), F.lit(level)).cast("double") / 2.0 ** 64 + 0.5) < F.col("share")
        got = rows.join(F.broadcast(shares), "cell").where(drawn).select("cell", "vec").toArrow()      # the next nodes: part of the bounded tree
        chosen: dict[int, list[bytes]] = {}
        for node, vec in zip(got.column(0).to_numpy().tolist(), got.column(1)):
            chosen.setdefault(node, []).append(vec.as_py())
        centres = {node: sorted(chosen[node])[:2 * fanout] for node in open_ if len(chosen.get(node, [])) > 1}
        if centres:
            tree.grow({node: np.frombuffer(b"".join(own), np.float64).reshape(-1, dim) for node, own in centres.items()})
        to = {node: (np.arange(own.start, own.stop), tree.centre[own]) for node in centres for own in (tree.children(node),)}
        if not to:
            break
        rows = save_table(_dealt(rows, to, dim), "knn-dealt")
        _stats(rows, tree)
        back = {}
        for node, (ids, centres) in to.items():
            enough = tree.size[ids] >= least
            if not enough.all():                              # at least one child has enough: the node has many points
                rest = ids[enough], centres[enough]           # one for all of the node's children that are given up
                back |= {int(i): rest for i in ids[~enough & (tree.size[ids] > 0)]}
                tree.size[ids[~enough]] = 0
        if back:
            rows = _dealt(rows, back, dim)
            _stats(rows, tree)
        # a node whose points all went to one child is as far as it gets
        open_ = [int(i) for node, (ids, _) in to.items() if (tree.size[ids] > 0).sum() > 1 for i in ids if tree.size[i] > 2 * leaf]
    return rows, tree


def candidate_cells(df: DataFrame, id_col: str, feature_cols: Sequence[str], k: int, seed: int, pivots: int | None, block: int,
                    leaf: int | None = None):
    """(points, queries, cuts): points (cell, blk, id, vec) in their leaves,
    queries (cell, id, vec, reach) in every leaf that may hold a neighbour,
    and the number of blocks per leaf.  None for fewer than two points."""
    spark, dim = df.sparkSession, len(feature_cols)
    pts = df.select(c(id_col).alias("id"), *[c(f).cast("double").alias(f"x{i}") for i, f in enumerate(feature_cols)])
    kind = pts.schema["id"].dataType.simpleString()

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(j + 1).to_numpy(zero_copy_only=False) for j in range(dim)], 1).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(np.zeros(len(x), np.int32)), pa.array(np.zeros(len(x)))],
                                             names=["id", "vec", "cell", "d"])

    rows = save_table(pts.mapInArrow(root, f"id {kind}, vec binary, cell int, d double"), "knn-points")
    n = rows.count()
    if n <= 1:
        return None
    small = leaf or max(LEAF_ROWS, -(-4 * n * (8 * dim + 32) // TREE_BYTES))     # two nodes for each leaf's worth of points
    dealt, tree = pivot_tree(rows, dim, n, k + 1, seed, pivots or FANOUT, small)
    leaves = np.flatnonzero((tree.many == 0) & (tree.size > 0))
    cuts = spark.createDataFrame(pa.table({"cell": leaves.astype(np.int32), "cuts": np.maximum(1, tree.size[leaves] // block).astype(np.int32)}))
    points = dealt.join(F.broadcast(cuts), "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias("blk"), "id", "vec", "d")
    shared = spark.sparkContext.broadcast(tree)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for cell, ids, x, d in _blocks_of(batches, dim):
            # no neighbour is beyond the k-th of the own block; all points of the leaf are within d + U
            reach = np.where(tree.size[cell] > k, d + tree.radius[cell], np.inf)
            if len(x) > k:
                for s in range(0, len(x), 1024):
                    reach[s:s + 1024] = np.minimum(reach[s:s + 1024], np.partition(_distances(x[s:s + 1024], x), k, axis=1)[:, k] * (1 + 1e-9) + 1e-12)
            to, row = zip(*((np.full(len(own), found, np.int32), own) for found, own in tree.leaves_within(x, reach)))
            row = np.concatenate(row)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(to)), ids.take(at), pa.array([v.tobytes() for v in x], pa.binary()).take(at), pa.array(reach[row])], names=["cell", "id", "vec", "reach"])

    together = points.repartition("cell", "blk").sortWithinPartitions("cell", "blk")
    return points.drop("d"), together.mapInArrow(send, f"cell int, id {kind}, vec binary, reach double"), cuts


def _blocks_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(cell, ids, vectors, distances to the pivot) of each block of sorted
    (cell, blk, id, vec, d) rows, whatever batches it spans."""
    held: list[pa.RecordBatch] = []

    def whole():
        table = pa.Table.from_batches(held).combine_chunks()
        vec = table.column(3).chunk(0)
        return table.column(0)[0].as_py(), table.column(2).chunk(0), _matrix(vec, dim), table.column(4).to_numpy()

    for batch in batches:
        cell, blk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (blk[1:] != blk[:-1]), [True]])) if len(cell) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (int(cell[a]), int(blk[a])):
                yield whole()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield whole()


def knn_distinct(df: DataFrame, id_col: str, feature_cols: Sequence[str], k: int = 5, seed: int = 0,
                 pivots: int | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """(id, nbr_id, nbr_rank, dist) for the k nearest other points of each
    point, for a table of distinct vectors (fewer when it has <= k points)."""
    dim = len(feature_cols)
    found = candidate_cells(df, id_col, feature_cols, k, seed, pivots, block)
    if found is None:
        return df.select(c(id_col).alias("id"), c(id_col).alias("nbr_id"), F.lit(0).alias("nbr_rank"), F.lit(0.0).alias("dist")).limit(0)
    points, sent, cuts = found
    kind = points.schema["id"].dataType.simpleString()
    asked = sent.join(F.broadcast(cuts), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("blk"), "id", "vec", "reach")
    both = points.select("*", F.lit(None).cast("double").alias("reach"), F.lit(0).alias("side")).unionByName(asked.withColumn("side", F.lit(1)))
    both = both.repartition("cell", "blk").sortWithinPartitions("cell", "blk", "side").select("cell", "blk", "side", "id", "vec", "reach")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mine = None, []
        for batch in batches:
            cell, blk, side = (batch.column(j).to_numpy() for j in range(3))
            cut = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (blk[1:] != blk[:-1]) | (side[1:] != side[:-1]), [True]])) if len(cell) else np.zeros(1, np.int64)
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                ids, x = batch.column(3).slice(a, b - a).to_numpy(zero_copy_only=False), _matrix(batch.column(4).slice(a, b - a), dim)
                if side[a] == 0:
                    if key != (cell[a], blk[a]):
                        key, mine = (cell[a], blk[a]), [ids, x]
                    else:                                      # the block goes on in the next batch
                        mine = [np.concatenate(m) for m in zip(mine, (ids, x))]
                    continue
                if key != (cell[a], blk[a]):                   # queries to a block without points
                    continue
                reach = batch.column(5).slice(a, b - a).to_numpy(zero_copy_only=False)
                for s in range(0, len(ids), 1024):
                    d = _distances(x[s:s + 1024], mine[1])
                    row, col = np.nonzero(d <= reach[s:s + 1024][:, None])
                    other = mine[0][col] != ids[s:s + 1024][row]
                    row, col = row[other], col[other]
                    keep = _best(row, d[row, col], mine[0][col], k)
                    row, col = row[keep], col[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s:s + 1024][row]), pa.array(mine[0][col]), pa.array(d[row, col])], names=["id", "nbr_id", "dist"])

    met = both.mapInArrow(search, f"id {kind}, nbr_id {kind}, dist double")
    # at most k rows of each leaf that a point was sent to
    order = Window.partitionBy("id").orderBy("dist", "nbr_id")
    return met.withColumn("nbr_rank", F.row_number().over(order)).where(F.col("nbr_rank") <= k).select("id", "nbr_id", "nbr_rank", "dist")


_SALT = 64


def smallest_ids(rows: DataFrame, group_cols: Sequence[str], id_col: str, n: int) -> DataFrame:
    """(group..., ids): the n smallest ids per group, ascending.  Salted
    two-stage top-k, so a group holding a third of the rows is cut into
    _SALT pieces before anything is ranked; no group is ever collected."""
    salted = rows.select(*group_cols, id_col, F.pmod(F.xxhash64(id_col), F.lit(_SALT)).alias("_s"))
    w = Window.partitionBy(*group_cols, "_s").orderBy(id_col)
    pre = salted.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    # at most _SALT * n rows per group survive
    return pre.groupBy(*group_cols).agg(F.slice(F.array_sort(F.collect_list(id_col)), 1, n).alias("ids"))


def knn(df: DataFrame, id_col: str, feature_cols: Sequence[str], k: int = 5, seed: int = 0,
        pivots: int | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """Exact k nearest other rows of every row: (id, nbr_id, nbr_rank, dist),
    ties by id -- identical to ranking all pairs by (dist, nbr_id).  ``id_col``
    must be a unique key (as for the split and SMOTE).

    Rows are collapsed to distinct feature vectors first, so repeated
    vectors (even one vector holding a third of the table) never produce
    quadratic candidate sets.  A row's candidates are the other rows of its
    own vector (distance 0) and the rows of its vector's k nearest distinct
    vectors; only the k + 1 smallest ids of each vector can ever be needed.
    The candidates (at most (k + 1)^2 per row) are re-ranked by (dist, id).
    """
    feats = list(feature_cols)
    fcols = [f"_f{i}" for i in range(len(feats))]
    pts = df.select(c(id_col).alias("_id"), *[c(f).cast("double").alias(n) for f, n in zip(feats, fcols)])
    vecs = pts.groupBy(*fcols).agg(F.min("_id").alias("vid"))
    vecs = vecs.join(smallest_ids(pts, fcols, "_id", k + 1), fcols)  # one row per vector on both sides
    nn = knn_distinct(vecs, "vid", fcols, k, seed, pivots, block)
    nbr_ids = vecs.select(F.col("vid").alias("nbr_vid"), F.col("ids").alias("nbr_ids"))
    lists = (nn.select(F.col("id").alias("vid"), F.col("nbr_id").alias("nbr_vid"), "dist")
             .join(nbr_ids, "nbr_vid")
             .groupBy("vid").agg(F.collect_list(F.struct("dist", "nbr_ids")).alias("nbrs")))  # <= k per vector
    per_vec = vecs.join(lists, "vid", "left")
    rows = pts.join(per_vec, fcols)  # one row per vector on the right side
    same = F.transform(F.filter(F.col("ids"), lambda x: x != F.col("_id")),
                       lambda x: F.struct(F.lit(0.0).alias("dist"), x.alias("nbr_id")))
    id_t = pts.schema["_id"].dataType.simpleString()
    others = F.flatten(F.transform(
        F.coalesce(F.col("nbrs"), F.array().cast(f"array<struct<dist:double,nbr_ids:array<{id_t}>>>")),
        lambda s: F.transform(s["nbr_ids"], lambda x: F.struct(s["dist"].alias("dist"), x.alias("nbr_id")))))
    ranked = F.slice(F.array_sort(F.concat(same, others)), 1, k)
    return (rows.select(F.col("_id").alias("id"), F.posexplode(ranked).alias("pos", "nb"))
            .select("id", F.col("nb.nbr_id").alias("nbr_id"), (F.col("pos") + 1).cast("int").alias("nbr_rank"),
                    F.col("nb.dist").alias("dist")))
