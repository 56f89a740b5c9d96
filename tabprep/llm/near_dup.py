"""Near-duplicate documents: MinHash signatures and a multi-index Hamming join.

Sets are the distinct five-word shingles of a whole text (A-Z lower-cased).
Documents with equal sets collapse to one representative.  A signature has
SYMBOLS min-hash values of 16 bits; two sets of similarity s differ in about
(1 - s) of them.  Pairs are wanted up to RADIUS differing symbols.  The
signature is split into CHUNKS chunks; as RADIUS < 2 * CHUNKS, a wanted pair
has a chunk with one error at most (pigeonhole).  For each chunk the allowed
error is enumerated by leaving out one symbol at a time, so the pair shares
at least one of the SYMBOLS keys: the join finds every pair within RADIUS.
At similarity 0.75 a pair exceeds RADIUS = 31 of 64 with probability about
1e-5.

Buckets (equal keys) are never expanded into all pairs.  First every member
is compared with the bucket's most central member, the one whose keys are
the most shared; verified links join a copy group into one component at a
cost linear in its size.  In buckets that still hold several components, the
signatures say which components have members within RADIUS of one another;
such components form a cluster, and within it the full sets are compared
across components, in blocks of bounded size inside Arrow tasks, which
report links only.  Every link is confirmed on the full shingle sets.

Results: a text without words, or a null text, has an empty set, no links and
its own id as component; fewer than five words form one shingle; rows with
equal ids are rows of their own, and their component's id is the smallest
non-null id in it (null if it has none); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .kernels import blocks, mix, shingle_sets
from .shared import Scratch, sized

SHINGLE, SYMBOLS, CHUNKS, RADIUS = 5, 64, 16, 31
BLOCK_ROWS = 1024
_MULTIPLY = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFT = mix(np.arange(101, SYMBOLS + 101, dtype=np.uint64))


def set_nodes(value: np.ndarray, off: np.ndarray) -> list[bytes | None]:
    """128-bit name of each set, None for an empty one; equal sets, equal names."""
    total = [np.concatenate([[np.uint64(0)], np.cumsum(mix(value ^ salt))]) for salt in (np.uint64(0x1234567), np.uint64(0x89ABCDEF01))]
    names = np.stack([t[off[1:]] - t[off[:-1]] for t in total], 1)
    return [names[i].tobytes() if off[i + 1] > off[i] else None for i in range(len(off) - 1)]


def minhash(value: np.ndarray, off: np.ndarray) -> np.ndarray:
    """rows x SYMBOLS of 16 bits; zero for empty sets."""
    out = np.zeros((len(off) - 1, SYMBOLS), np.uint16)
    filled = np.flatnonzero(off[1:] > off[:-1])
    if len(filled):
        for k in range(SYMBOLS):
            h = (((value ^ _SHIFT[k]) * _MULTIPLY[k]) >> np.uint64(32)).astype(np.uint32)
            out[filled, k] = np.minimum.reduceat(h, off[:-1][filled]).astype(np.uint16)
    return out


def signatures(documents: DataFrame, *, id_col: str, text: str) -> DataFrame:
    """(id, hash of the text, n_shingles, node, sig) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            value, cut = shingle_sets(buf, off, SHINGLE)
            sig = minhash(value, cut)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(cut)), pa.array(set_nodes(value, cut), pa.binary()), pa.array([s.tobytes() for s in sig], pa.binary())],
                                             names=["id", "th", "n_shingles", "node", "sig"])

    kind = documents.select(id_col).schema[0].dataType.simpleString()
    source = documents.select(documents[id_col].alias("id"), F.xxhash64(documents[text]).alias("th"), documents[text].alias("__text"))
    return source.mapInArrow(run, f"id {kind}, th bigint, n_shingles bigint, node binary, sig binary")


def _sig(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def index_keys(reps: DataFrame) -> DataFrame:
    """(key, rep): SYMBOLS keys per representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = SYMBOLS // CHUNKS
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                sig = _sig(part.column(1)).reshape(part.num_rows, CHUNKS, wide).astype(np.uint64)
                out = np.empty((part.num_rows, CHUNKS, wide), np.uint64)
                for left_out in range(wide):
                    left = [c for c in range(wide) if c != left_out]
                    h = np.arange(CHUNKS, dtype=np.uint64)[None, :] * np.uint64(wide) + np.uint64(left_out + 1)
                    for c in left:
                        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, c])
                    out[:, :, left_out] = h
                yield pa.RecordBatch.from_arrays([pa.array(out.reshape(-1).view(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(zero_copy_only=False), SYMBOLS))], names=["key", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, "key bigint, rep bigint")


def _near(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, d) of the pairs within RADIUS."""
    left, right = (reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 8192):
                part = batch.slice(k, 8192)
                d = (_sig(part.column(2)) != _sig(part.column(3))).sum(1)
                ok = pa.array(d <= RADIUS)
                yield pa.RecordBatch.from_arrays([part.column(0).filter(ok), part.column(1).filter(ok), pa.array(d).filter(ok)], names=["a", "b", "d"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a bigint, b bigint, d bigint")


def _texts(ids: DataFrame, reps: DataFrame, documents: DataFrame, id_col: str, text: str, scratch: Scratch, repeated: bool) -> DataFrame:
    """(rep, text) of the wanted representatives; ids: (rep)."""
    wanted = scratch.save(ids.join(reps.select("rep", "id"), "rep").select(F.col("id").alias("__id"), F.col("rep").alias("__rep")), "wanted")
    texts = (documents.select(documents[id_col].alias("__doc"), documents[text].alias("__text"))
             .join(sized(wanted, wanted.count()), F.col("__doc").eqNullSafe(F.col("__id"))).select("__rep", "__text"))
    # ids may repeat with other texts: the text must give the representative's own set

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            value, cut = shingle_sets(buf, off, SHINGLE)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(set_nodes(value, cut), pa.binary())], names=["rep", "text", "own"])

    if repeated:
        texts = texts.mapInArrow(named, "rep bigint, text string, own binary").join(reps.select("rep", "node"), "rep").where("own = node").groupBy("rep").agg(F.min("text").alias("text"))
    return texts.toDF("rep", "text")


def _verify(pairs: DataFrame, reps: DataFrame, **source) -> DataFrame:
    """(a, b, linked) of saved, distinct pairs, judged on the full sets."""
    scratch = source["scratch"]
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    texts = scratch.save(_texts(ids, reps, **source), "texts")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "text_a", 1 << 20):
            value, cut = shingle_sets(buf, off, SHINGLE)
            for more, buf2, off2 in blocks(iter([rows]), "text_b", 1 << 62):
                value2, cut2 = shingle_sets(buf2, off2, SHINGLE)
                linked = []
                for i in range(more.num_rows):
                    x, y = value[cut[i]:cut[i + 1]], value2[cut2[i]:cut2[i + 1]]
                    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) and len(y) else 0
                    linked.append(100 * both >= 75 * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([more.column(0), more.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    with_texts = pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    out = scratch.save(with_texts.mapInArrow(judge, "a bigint, b bigint, linked boolean"), "judged")
    scratch.drop(texts)
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows arranged by the keys, in tables that hold whole groups."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        new = np.zeros(max(table.num_rows - 1, 0), bool)
        for k in keys:
            column = table.column(k).to_numpy()
            new |= column[1:] != column[:-1]
        last = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups begin, and the number of rows."""
    new = np.ones(table.num_rows + 1, bool)
    new[1:-1] = False
    for k in keys:
        column = table.column(k).to_numpy()
        new[1:-1] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _in_blocks(rows: DataFrame, key: str, n: str, by: str) -> DataFrame:
    """Give rows of a group of ``n`` rows to all pairs (lo, hi) of its blocks
    of about BLOCK_ROWS rows; ``blk`` is the row's own block."""
    cuts = F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    rows = rows.withColumn("blk", F.pmod(F.xxhash64(by), cuts).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), cuts - 1)))
    rows = rows.withColumn("lo", F.least("blk", "o")).withColumn("hi", F.greatest("blk", "o")).drop("o", n)
    return rows.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def _neighbours(members: DataFrame) -> DataFrame:
    """(a, b): in each block pair of a bucket, the components that have a member
    within RADIUS of another component's member, tied to the smallest of them.

    members: (key, rep, comp, sig, blk, lo, hi), arranged by _in_blocks."""
    keys = ["key", "lo", "hi"]

    def involved(comp, sig, blk, two):
        """Components of one larger group with such a member."""
        values, count = np.unique(comp, return_counts=True)
        few = np.flatnonzero(comp != values[count.argmax()]) if len(values) > 1 else np.zeros(0, np.int64)
        found = [np.zeros(0, np.int64)]
        for k in range(0, len(few), 128):
            i = few[k:k + 128]
            d = np.zeros((len(i), len(comp)), np.uint8)
            for s in range(SYMBOLS):
                d += sig[i, s][:, None] != sig[:, s][None, :]
            ok = (d <= RADIUS) & (comp[i][:, None] != comp[None, :])
            if two:
                ok &= blk[i][:, None] != blk[None, :]
            a, b = np.nonzero(ok)
            found += [np.unique(comp[i[a]]), np.unique(comp[b])]
        return np.unique(np.concatenate(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, keys):
            comp, blk, lo, hi = (t.column(c).to_numpy() for c in ("comp", "blk", "lo", "hi"))
            sig, cut = _sig(t.column("sig").chunk(0)), _starts(t, keys)
            size = np.diff(cut)
            group = np.repeat(np.arange(len(size)), size)
            out = [np.zeros((0, 2), np.int64)]
            at = np.flatnonzero(size[group] <= 32)
            for step in range(1, 32):                          # all small groups at once, by distance of places
                at = at[at + step < len(group)]
                at = at[group[at] == group[at + step]]
                x = at[(comp[at] != comp[at + step]) & ((lo[at] == hi[at]) | (blk[at] != blk[at + step]))]
                x = x[(sig[x] != sig[x + step]).sum(1) <= RADIUS]
                out.append(np.stack([comp[x], comp[x + step]], 1))
            for g in np.flatnonzero(size > 32):
                s = slice(cut[g], cut[g + 1])
                own = involved(comp[s], sig[s], blk[s], lo[cut[g]] != hi[cut[g]])
                out.append(np.stack([own[1:], np.full(max(len(own) - 1, 0), own[0] if len(own) else 0)], 1))
            pairs = np.unique(np.sort(np.concatenate(out), 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return members.select(*keys, "rep", "comp", "sig", "blk").mapInArrow(run, "a bigint, b bigint")


def _links_across(sets: DataFrame) -> DataFrame:
    """(a, b): for each representative and each other component of its cluster
    with a set of similarity 0.75 or more to its own, one such link.

    sets: (cluster, rep, comp, shingles, blk, lo, hi), arranged by _in_blocks.
    The rows of the largest component of a block pair are not compared with
    one another, all others with every row, by counting shared shingles."""
    keys = ["cluster", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, keys):
            rep, comp, blk, lo, hi = (t.column(c).to_numpy() for c in ("rep", "comp", "blk", "lo", "hi"))
            column, cut, out = t.column("shingles").chunk(0), _starts(t, keys), []
            for g in range(len(cut) - 1):
                a, b = int(cut[g]), int(cut[g + 1])
                values, count = np.unique(comp[a:b], return_counts=True)
                if len(values) < 2:
                    continue
                own = [np.frombuffer(x.as_py(), np.uint64) for x in column[a:b]]
                size = np.array([len(x) for x in own])
                every = np.concatenate(own)
                order = np.argsort(every, kind="stable")
                every, of = every[order], np.repeat(np.arange(b - a), size)[order]
                for i in np.flatnonzero(comp[a:b] != values[count.argmax()]).tolist():
                    first, last = np.searchsorted(every, own[i], "left"), np.searchsorted(every, own[i], "right")
                    n = last - first
                    total = np.cumsum(n)
                    both = np.bincount(of[np.arange(total[-1]) + np.repeat(first - total + n, n)], minlength=b - a)
                    ok = (100 * both >= 75 * (size[i] + size - both)) & (comp[a:b] != comp[a + i])
                    if lo[a] != hi[a]:
                        ok &= blk[a:b] != blk[a + i]
                    hit = np.flatnonzero(ok)
                    _, one = np.unique(comp[a:b][hit], return_index=True)
                    out += [(int(rep[a + i]), int(rep[a + j])) for j in hit[one].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return sets.select(*keys, "rep", "comp", "shingles", "blk").mapInArrow(run, "a bigint, b bigint")


def _sets(ids: DataFrame, reps: DataFrame, **source) -> DataFrame:
    """(rep, shingles): the sorted shingles of the wanted representatives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "text"):
            value, cut = shingle_sets(buf, off, SHINGLE)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["rep", "shingles"])

    return _texts(ids, reps, **source).mapInArrow(run, "rep bigint, shingles binary")


def _grouped(documents: DataFrame, scratch: Scratch, *, id_col: str, text: str) -> DataFrame:
    """(id, th, n_shingles, comp, component_id) of every row; comp is null for empty sets."""
    rows = scratch.save(signatures(documents, id_col=id_col, text=text), "signatures")
    repeated = not rows.groupBy("id").count().where("count > 1").isEmpty()
    reps = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("sig").alias("sig"))
    reps = scratch.save(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    keys = index_keys(reps)
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.save(keys.join(shared, "key"), "members")
    # 1: the most central member of each bucket
    central = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighed = members.join(central, "rep")
    pivots = weighed.groupBy("key").agg(F.max(F.struct("weight", F.col("rep").alias("pivot"))).alias("p")).select("key", "p.pivot")
    first = members.join(pivots, "key").where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    best = lambda pairs: pairs.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()
    source = {"documents": documents, "id_col": id_col, "text": text, "scratch": scratch, "repeated": repeated}
    judged = _verify(scratch.save(best(_near(first, reps)), "first"), reps, **source)
    comp = components(judged.where("linked"), scratch)
    # 2: buckets that hold several components say which components are neighbours
    of = reps.select("rep").join(comp, F.col("rep") == F.col("v"), "left").select("rep", F.coalesce("c", "rep").alias("comp"))
    of = scratch.save(of, "components")
    labelled = members.select("key", "rep").join(of, "rep")
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n")).where("x <> y").select("key", "n")
    near = _neighbours(_in_blocks(labelled.join(mixed, "key").join(reps.select("rep", "sig"), "rep"), "key", "n", "rep"))
    clusters = components(scratch.save(near.distinct(), "neighbours"), scratch)
    # 3: full sets are compared within clusters of neighbours
    inside = scratch.save(of.join(clusters, F.col("comp") == F.col("v")).select("rep", "comp", F.col("c").alias("cluster")), "clusters")
    sizes = inside.groupBy("cluster").agg(F.count("*").alias("n"))
    sets = scratch.save(_sets(inside.select("rep"), reps, **source), "sets")
    links = _links_across(_in_blocks(inside.join(sizes, "cluster").join(sets, "rep"), "cluster", "n", "rep"))
    comp = components(scratch.save(judged.where("linked").select("a", "b").unionByName(links), "links"), scratch)
    scratch.drop(sets)
    labelled = reps.join(comp, F.col("rep") == F.col("v"), "left").select("node", "id", F.coalesce("c", "rep").alias("comp"))
    smallest = labelled.groupBy("comp").agg(F.min("id").alias("component_id"))
    named = scratch.save(labelled.join(smallest, "comp").select("node", "comp", "component_id"), "named")
    out = rows.drop("sig").join(sized(named, named.count()), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "th", "n_shingles", "comp", component.alias("component_id"))


def find_groups(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    rows = _grouped(documents, Scratch(documents.sparkSession, "near-dup"), id_col=id_col, text=text)
    return rows.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one row of each component (the smallest non-null id);
    rows without words all stay, but of rows with equal id and text one does."""
    scratch = Scratch(documents.sparkSession, "near-dup")
    rows = scratch.save(_grouped(documents, scratch, id_col=id_col, text=text), "grouped")
    stays = rows.where("comp is not null").groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "th")).alias("s")).select("s.id", "s.th")
    gone = rows.where("comp is not null").select(F.col("id").alias("__i"), F.col("th").alias("__t")).distinct()
    gone = scratch.save(gone.join(stays, F.col("__i").eqNullSafe(F.col("id")) & (F.col("__t") == F.col("th")), "left_anti"), "gone")
    own = F.xxhash64(documents[text])
    out = documents.join(sized(gone, gone.count()), documents[id_col].eqNullSafe(F.col("__i")) & (own == F.col("__t")), "left_anti")
    if rows.groupBy("id", "th").count().where("count > 1").isEmpty():
        return out
    return out.withColumn("__th", F.xxhash64(text)).dropDuplicates([id_col, "__th"]).drop("__th")


def oracle_sql(*, percent: int = 75) -> str:
    """DuckDB SQL for ``find_groups``: all pairs that share a shingle, and the
    smallest vertex that reaches each one, by recursion (small tables only)."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 4)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * both_ >= {percent} * (p.n + q.n - both_)),
reach(v, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT b, c FROM reach JOIN links ON a = v AND c < b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v, min(c) AS c FROM reach GROUP BY v) m ON m.v = d.doc_id"""
