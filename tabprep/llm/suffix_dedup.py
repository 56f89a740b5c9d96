"""Removal of long repeated byte strings with a logarithmic family of sparse
suffix arrays.

Every string of ``length`` bytes is judged by one anchor inside it: the
leftmost smallest-hash position among its first REACH bytes.  Equal strings
have their anchor at the same place, so it is enough to index the suffixes
that start at anchors, about two in REACH positions, by a key of what every
string with that anchor has in common (its "core", ``length - REACH + 1``
bytes).  The suffix arrays are sorted tables of keys, bucketed and sorted by
key in the shared folder: a new batch of documents gets its array, is
merge-scanned (sort-merge join, no shuffle) against the arrays of earlier
batches, and arrays of equal rank are merged into one of the next rank.

The keys that were met twice are the candidates.  Strings that share an
anchor are consecutive, so a whole run of them is settled at once if the
bytes that the run covers occur twice.  What is left are the edges of
matches: their bytes are brought together by core and all their strings are
compared there; cores with more than ``crowded`` different runs are compared
string by string in a distributed count instead.  Equality is that of two
independent 64-bit hashes.

Texts are taken as UTF-8 bytes, strings never cross texts, and every
occurrence is removed, overlaps included.  A null text counts as empty; a
text shorter than ``length`` loses nothing; rows that repeat lose all they
can; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import BLOCK_BYTES, SpanHash, blocks, mix
from .shared import Scratch, sized

REACH, GRAM = 256, 24


def _segments(buf: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a block with one huge row: each string lies in one piece."""
    if len(buf) <= 2 * BLOCK_BYTES or len(off) > 2:
        yield 0, buf, off
        return
    for at in range(0, len(buf) - length + 1, BLOCK_BYTES):
        piece = buf[at:at + BLOCK_BYTES + length - 1]
        yield at, piece, np.array([0, len(piece)], np.int64)


def anchor_runs(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[SpanHash, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(hashes, row, anchor, lo, hi): runs lo..hi of string starts with one anchor."""
    if len(buf) < length:
        return None
    hashes = SpanHash(buf)
    at = np.arange(len(buf) - GRAM + 1)
    least = (mix(hashes(at, at + GRAM)) & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    span = 1
    while span * 2 <= REACH:
        least = np.minimum(least[:len(least) - span], least[span:])
        span *= 2
    start = np.arange(len(buf) - length + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[start]
    inside = start + length <= off[row + 1]
    start, row = start[inside], row[inside]
    if not len(start):
        return None
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
    return hashes, row[new], anchor[new], start[new], np.append(start[new[1:] - 1], start[-1])


def _source(documents: DataFrame, id_col: str, text: str) -> DataFrame:
    return documents.select(documents[id_col].alias("id"), F.xxhash64(documents[text]).alias("th"), documents[text].alias("__text"))


def core_keys(documents: DataFrame, *, id_col: str, text: str, length: int, batches: int) -> DataFrame:
    """(core, batch): the key of every anchored suffix."""
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(found, "__text"):
            text_hash = rows.column(1).to_numpy()
            for _, piece, cut in _segments(buf, off, length):
                got = anchor_runs(piece, cut, length)
                if got:
                    hashes, row, anchor, _, _ = got
                    core = hashes(anchor, anchor + length - REACH + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64)), pa.array((text_hash[row] % batches).astype(np.int32))], names=["core", "batch"])

    return _source(documents, id_col, text).mapInArrow(run, "core bigint, batch int")


class SuffixIndex:
    """Sorted key tables of ranks 0, 1, 2, ...; rank r holds 2^r batches."""

    def __init__(self, spark: SparkSession, scratch: Scratch):
        self.spark, self.scratch = spark, scratch
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, DataFrame] = {}

    def _table(self, df: DataFrame) -> DataFrame:
        self.scratch.made += 1
        name = f"tabprep_suffixes_{uuid.uuid4().hex}"
        path = f"{self.scratch.root}/{self.scratch.made:03d}-level"
        df.write.bucketBy(self.buckets, "core").sortBy("core").option("path", path).saveAsTable(name)
        out = self.spark.table(name)
        out._scratch_path, out._name = path, name
        return out

    def _forget(self, *tables: DataFrame) -> None:
        for t in tables:
            self.spark.sql(f"drop table {t._name}")
        self.scratch.drop(*tables)

    def add(self, cores: DataFrame) -> DataFrame:
        """Take in a batch; the keys it shares with itself or an earlier batch."""
        # hash-partitioned by the aggregate as the buckets are, so a bucket is written by one task
        new = self._table(cores.groupBy("core").agg(F.count("*").alias("n")))
        hits = new.where("n > 1").select("core")
        for level in self.levels.values():
            hits = hits.unionByName(new.hint("merge").join(level.select("core"), "core").select("core"))
        hits = self.scratch.save(hits.distinct(), "hits")
        rank = 0
        while rank in self.levels:
            old = self.levels.pop(rank)
            both = new.hint("merge").join(old.withColumnRenamed("n", "m"), "core", "full").select("core", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
            merged = self._table(both)
            self._forget(new, old)
            new, rank = merged, rank + 1
        self.levels[rank] = new
        return hits

    def close(self) -> None:
        self._forget(*self.levels.values())
        self.levels = {}


def candidate_runs(documents: DataFrame, *, id_col: str, text: str, length: int) -> DataFrame:
    """(core, cover, id, th, lo, hi) of every run of strings with one anchor."""
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(found, "__text"):
            for at, piece, cut in _segments(buf, off, length):
                got = anchor_runs(piece, cut, length)
                if got:
                    hashes, row, anchor, lo, hi = got
                    core = hashes(anchor, anchor + length - REACH + 1).view(np.int64)
                    cover = SpanHash(piece, second=True)(lo, hi + length).view(np.int64)
                    of = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(cover), rows.column(0).take(of), rows.column(1).take(of), pa.array(lo - cut[row] + at), pa.array(hi - cut[row] + at)],
                                                     names=["core", "cover", "id", "th", "lo", "hi"])

    kind = documents.select(id_col).schema[0].dataType.simpleString()
    return _source(documents, id_col, text).mapInArrow(run, f"core bigint, cover bigint, id {kind}, th bigint, lo bigint, hi bigint")


def _regions(documents: DataFrame, runs: DataFrame, *, id_col: str, text: str, length: int, rows: int) -> DataFrame:
    """(core, id, th, lo, region): the bytes that each run covers."""
    per_text = runs.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.collect_list(F.struct("core", "lo", "hi")).alias("runs"))
    source = _source(documents, id_col, text)
    joined = source.join(sized(per_text, rows), source["id"].eqNullSafe(F.col("i")) & (source["th"] == F.col("t")))
    joined = joined.groupBy("id", "th").agg(F.first("__text").alias("__text"), F.first("runs").alias("runs")) if not documents.groupBy(id_col).count().where("count > 1").isEmpty() else joined

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, buf, off in blocks(found, "__text"):
            raw, out = buf.tobytes(), []
            for i, own in enumerate(rows_.column(3).to_pylist()):
                out += [(r["core"], i, r["lo"], raw[off[i] + r["lo"]:off[i] + r["hi"] + length]) for r in own]
            at = pa.array([o[1] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), rows_.column(0).take(at), rows_.column(1).take(at), pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.binary())],
                                             names=["core", "id", "th", "lo", "region"])

    kind = documents.select(id_col).schema[0].dataType.simpleString()
    return joined.select("id", "th", "__text", "runs").mapInArrow(cut, f"core bigint, id {kind}, th bigint, lo bigint, region binary")


def _strings(regions: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of every string in the regions, its region and its place there."""
    off = np.concatenate([[0], np.cumsum([len(r) for r in regions])]).astype(np.int64)
    buf = np.frombuffer(b"".join(regions), np.uint8)
    of = np.repeat(np.arange(len(regions)), np.maximum(np.diff(off) - length + 1, 0))
    count = np.bincount(of, minlength=len(regions))
    place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    at = off[of] + place
    return SpanHash(buf)(at, at + length), SpanHash(buf, second=True)(at, at + length), of, place


def _marks(of: np.ndarray, place: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated starts: (region, first start, last start) in the text."""
    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)])) if len(of) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(of))[:len(new)] - 1
    return of[new], lo[of[new]] + place[new], lo[of[new]] + place[last]


def _compare_together(regions: DataFrame, length: int, kind: str) -> DataFrame:
    """(id, th, lo, hi): repeated strings among regions of one core."""
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            first, second, of, place = _strings(t.column("region").to_pylist(), length)
            if not len(first):
                return
            order = np.lexsort((second, first))
            a, b = first[order], second[order]
            same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            twice = np.zeros(len(first), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            region, lo, hi = _marks(of[twice], place[twice], t.column("lo").to_numpy())
            at = pa.array(region)
            yield pa.RecordBatch.from_arrays([t.column("id").combine_chunks().take(at), t.column("th").combine_chunks().take(at), pa.array(lo), pa.array(hi)], names=["id", "th", "lo", "hi"])

        for batch in found:
            for k in range(0, batch.num_rows, 4096):
                part = pa.Table.from_batches([batch.slice(k, 4096)])
                table = part if rest is None else pa.concat_tables([rest, part])
                core = table.column("core").to_numpy()
                new = np.flatnonzero(core[1:] != core[:-1])
                last = int(new[-1]) + 1 if len(new) else 0
                if last:
                    yield from work(table.slice(0, last).combine_chunks())
                rest = table.slice(last)
        if rest is not None and rest.num_rows:
            yield from work(rest.combine_chunks())

    return (regions.repartition("core").sortWithinPartitions("core").mapInArrow(run, f"id {kind}, th bigint, lo bigint, hi bigint"))


def _compare_counted(regions: DataFrame, length: int, kind: str) -> DataFrame:
    """The same by a distributed count of strings, for crowded cores."""
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                first, second, of, place = _strings(part.column(4).to_pylist(), length)
                at = pa.array(of)
                yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), part.column(1).take(at), part.column(2).take(at), pa.array(part.column(3).to_numpy()[of] + place)],
                                                 names=["x", "y", "id", "th", "at"])

    strings = regions.mapInArrow(run, f"x bigint, y bigint, id {kind}, th bigint, at bigint")
    twice = strings.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1")
    return strings.join(twice, ["x", "y"]).select("id", "th", F.col("at").alias("lo"), F.col("at").alias("hi"))


def repeated_runs(documents: DataFrame, *, id_col: str, text: str, length: int, batches: int, crowded: int, scratch: Scratch) -> DataFrame:
    """(id, th, lo, hi): runs of string starts that occur more than once."""
    spark = documents.sparkSession
    options = {"id_col": id_col, "text": text, "length": length}
    path = f"{scratch.root}/keys"
    core_keys(documents, batches=batches, **options).write.partitionBy("batch").parquet(path)
    keys = spark.read.schema("core bigint, batch int").parquet(path)
    index, hits = SuffixIndex(spark, scratch), None
    for b in range(batches):
        found = index.add(keys.where(F.col("batch") == b).select("core"))
        hits = found if hits is None else hits.unionByName(found)
    hits = scratch.save(hits.distinct(), "shared-keys")
    index.close()
    runs = scratch.save(candidate_runs(documents, **options).join(sized(hits, hits.count()), "core", "left_semi"), "candidates")
    covers = scratch.save(runs.groupBy("core", "cover").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "lo", "hi")).alias("one")), "covers")
    settled = runs.join(covers.where("n > 1").select("core", "cover"), ["core", "cover"], "left_semi").select("id", "th", "lo", "hi")
    settled = scratch.save(settled, "settled")
    mixed = covers.groupBy("core").agg(F.count("*").alias("k")).where("k > 1")
    edges = scratch.save(covers.select("core", "one.*").join(mixed, "core"), "edges")
    scratch.drop(runs, covers)
    regions = scratch.save(_regions(documents, edges, rows=edges.count(), **options).join(edges.where(F.col("k") > crowded).select("core").distinct().withColumn("crowd", F.lit(True)), "core", "left"), "regions")
    kind = documents.select(id_col).schema[0].dataType.simpleString()
    columns = ["core", "id", "th", "lo", "region"]
    fine = _compare_together(regions.where("crowd is null").select(columns), length, kind).unionByName(_compare_counted(regions.where("crowd").select(columns), length, kind))
    return settled.unionByName(scratch.save(fine, "fine"))


def _covered(marks: DataFrame, length: int, kind: str) -> DataFrame:
    """(i, t, spans): the bytes that a text's runs cover, as few spans (lo, end)."""
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                flat, off = part.column(2).flatten(), np.concatenate([[0], np.cumsum(part.column(2).value_lengths().to_numpy())])
                lo, end = flat.field(0).to_numpy(), flat.field(1).to_numpy() + length
                of = np.repeat(np.arange(part.num_rows), np.diff(off))
                order = np.lexsort((lo, of))
                lo, end, of = lo[order], end[order], of[order]
                # the furthest end so far within a text, by a running maximum that restarts with each text
                step = int(end.max()) + 1 if len(end) else 1
                far = np.maximum.accumulate(end + of * step) - of * step
                new = np.concatenate([[True], (of[1:] != of[:-1]) | (lo[1:] > far[:-1])]) if len(of) else np.zeros(0, bool)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(of))[:len(first)] - 1
                cut = np.searchsorted(of[first], np.arange(part.num_rows + 1)).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(lo[first]), pa.array(far[last])], names=["lo", "end"])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(cut), spans)], names=["i", "t", "spans"])

    return marks.mapInArrow(run, f"i {kind}, t bigint, spans array<struct<lo:bigint,end:bigint>>")


def remove_repeats(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", length: int = 400, batches: int = 4, crowded: int = 4096,
                   digests: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256 or kept bytes) per row."""
    if length < REACH + GRAM:
        raise ValueError(f"length must be {REACH + GRAM} at least")
    scratch = Scratch(documents.sparkSession, "suffix-dedup")
    found = repeated_runs(documents, id_col=id_col, text=text, length=length, batches=batches, crowded=crowded, scratch=scratch)
    kind = documents.select(id_col).schema[0].dataType.simpleString()
    marks = found.groupBy(F.col("id").alias("i"), F.col("th").alias("t")).agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    marks = scratch.save(_covered(marks, length, kind), "marks")
    total = marks.agg(F.sum(F.size("spans"))).first()[0] or 0
    source = _source(documents, id_col, text)
    joined = source.join(sized(marks, total), source["id"].eqNullSafe(F.col("i")) & (source["th"] == F.col("t")), "left").select("id", "__text", "spans")
    last = "kept_sha256" if digests else "kept"

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches_, "__text"):
            edge = np.zeros(len(buf) + 1, np.int64)
            spans = rows.column(2)
            flat = spans.flatten()
            if len(flat):
                of = np.repeat(off[:-1], spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                np.add.at(edge, of + flat.field(0).to_numpy(), 1)
                np.add.at(edge, of + flat.field(1).to_numpy(), -1)
            gone = np.cumsum(edge)[:-1] > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            starts = off[:-1][off[:-1] < len(buf)]
            first[starts] = gone[starts]
            total_gone, total_first = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, first))
            kept = [buf[a:b][~gone[a:b]].tobytes() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            per = lambda c: pa.array(c[off[1:]] - c[off[:-1]])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(off)), per(total_gone), per(total_first),
                                              pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()) if digests else pa.array(kept, pa.binary())],
                                             names=[id_col, "n_bytes", "n_removed", "n_spans", last])

    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {last} {'string' if digests else 'binary'}")
