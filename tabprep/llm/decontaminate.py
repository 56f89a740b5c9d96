"""Benchmark decontamination by CGK embedding and locality-sensitive hashing.

Texts are sequences of words (runs of letters and digits, A-Z lower-cased).
The CGK embedding walks through a sequence: step j writes the pair of words it
stands on and moves on by 0 or 1, as a random function of j and the pair says.
Two sequences at a small edit distance get embeddings at a small Hamming
distance, because their walks meet again after an edit.  Bit sampling of the
embedding is the hash: in each of ``repeats`` independent walks a few steps
are sampled, and the words written there form a key.  An item becomes a
candidate for a window of its size (in words) if one key agrees; candidates
are confirmed by the exact edit distance of the item to the best substring
around the window, at most ``max_share`` of the item's words.  Each size class
has the ``repeats`` with which the recall measured on copies of its own items
with as many edits as a match may have reaches ``recall``; where
``MOST_REPEATS`` do not, the call fails.

A text is walked only where a match can be.  An edit spoils at most RUN of the
RUN-word windows of an item, so a match of n words with e edits holds
n - RUN + 1 - RUN * e of them unchanged; stretches of that length with fewer
windows that some item has cannot match and are left out (nothing is lost).
All windows of what is left are walked at once.  Walks from neighbouring starts
that stand on the same word at the same step stay together, so they are
merged: the work per step shrinks with the root of the steps done.

Items of SHORT to SIZES[0] - 1 words are too short for walks: they match
verbatim, by the hashed windows of their own length.  Shorter items are not
searched for; a null or empty text has no windows; ids that repeat share one verdict; null ids are
one id; an empty table on either side gives no matches; equal items are each
reported; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, SpanHash, blocks, per_row, words
from .shared import Scratch, sized

#: Least words of each size class; windows of a class are sampled within its least size.
SIZES = (8, 12, 18, 27, 40, 60, 90)
#: Words of a window that a match shares with its item, and least words of an item.
RUN = 3
SHORT = 3
SAMPLES = 2
MOST_REPEATS = 64
EXACT_KEYS = 1_000_000
BITMAP_BITS = 22
PAD = np.uint64(0)

_LETTER = np.zeros(256, bool)
_LETTER[[b for b in range(256) if b >= 0x80 or chr(b).isalnum()]] = True
_RNG = np.random.default_rng(20240)
_STEP = _RNG.integers(0, 1 << 31, (MOST_REPEATS, 256), dtype=np.uint32) * np.uint32(2) + np.uint32(1)      # odd factors, per repeat and step


def sampled_steps(repeat: int, size_class: int) -> np.ndarray:
    """The steps whose words form the key.  A walk moves half a word a step, so
    they read within half of the class's least size."""
    least = SIZES[size_class]
    rng = np.random.default_rng(1000 * repeat + size_class)
    return np.sort(rng.choice(np.arange(int(0.4 * least), int(0.9 * least)), SAMPLES, replace=False))


def offset(repeat: int, size_class: int) -> int:
    """Where in an item the walk begins: at its start, or a quarter or half of
    the least size on, so that an edit does not stand in the way of all walks."""
    return repeat % 3 * SIZES[size_class] // 4


def word_symbols(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of all rows, each row followed by one PAD, and row offsets."""
    low = LOWER[buf]
    clean = np.where(_LETTER[low], low, np.uint8(32))
    start, end, row = words(clean, off)
    value = SpanHash(clean)(start, end) | np.uint64(1)                # never PAD, in its low half either
    n = len(off) - 1
    cut = per_row(row, n) + np.arange(n + 1)
    out = np.zeros(len(value) + n, np.uint64)
    out[np.arange(len(value)) + row] = value
    return out, cut


def walk_keys(symbol: np.ndarray, repeat: int, classes: list[int], starts: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size class: (class, first start of each group of starts that
    share a key, their keys); groups are in ascending order of start."""
    place = np.arange(len(symbol), dtype=np.int64) if starts is None else starts
    steps = {c: sampled_steps(repeat, c) for c in classes}
    key: dict[int, np.ndarray] = {}
    first: dict[int, np.ndarray] = {}
    if len(symbol):                            # a step reads a word and the next one: pairs are much rarer than words
        after = np.append(symbol[1:], PAD)
        symbol = np.where(symbol == PAD, PAD, (symbol * np.uint64(0xC2B2AE3D27D4EB4F) + (after ^ (after >> np.uint64(32)))) | np.uint64(1))
    lead = place                               # smallest start of each walker; ascending, as walks never cross
    low = symbol.astype(np.uint32)             # decides the moves; PAD is 0 and holds a walk
    for j in range(max((int(s[-1]) for s in steps.values()), default=-1) + 1):
        due = [c for c in classes if j in steps[c]]
        if due:
            here = symbol[place]
            walker = None
        for c in due:
            if c not in key:
                first[c], key[c] = lead, here + np.uint64(64 * repeat + c + 1)
            else:
                if walker is None:             # the walker of every start, by counting leads
                    at = np.zeros(len(symbol), np.int32)
                    at[lead] = 1
                    walker = np.cumsum(at, dtype=np.int32) - 1
                key[c] ^= key[c] >> np.uint64(31)
                key[c] *= np.uint64(0x9E3779B97F4A7C15)
                key[c] += here[walker[first[c]]]
            if j == steps[c][-1]:
                yield c, first[c], (key[c] ^ (key[c] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        place = place + ((low[place] * _STEP[repeat, j]) >> np.uint32(31))
        if j < 8 or j % 4 == 0:                # walks that met go on as one
            new = np.ones(len(place), bool)
            np.not_equal(place[1:], place[:-1], out=new[1:])
            place, lead = place[new], lead[new]


def window_hashes(symbol: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; 0 where a PAD is among them."""
    size = len(symbol) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    value, whole = np.full(size, n, np.uint64), np.ones(size, bool)
    for k in range(n):
        own = symbol[k:k + size]
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + own
        whole &= own != PAD
    return np.where(whole, value ^ (value >> np.uint64(29)) | np.uint64(1), PAD)


def shared_windows(n: int, edits: int) -> int:
    """How many RUN-word windows of an item of n words stay whole at least."""
    return n - RUN + 1 - RUN * edits


def stretches(symbol: np.ndarray, hit: np.ndarray, needs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The words that some match may cover: stretches of ``width`` words that
    hold ``least`` hits, for a (width, least) of ``needs``.  Returns the
    places kept, ascending, and where a new stretch begins among them."""
    total = np.concatenate([[0], np.cumsum(hit)])
    live = np.zeros(len(symbol) + 1, np.int32)
    for width, least in needs:
        if least < 1:                                      # nothing is known of such matches
            live[0] += 1
            continue
        start = np.flatnonzero(total[np.minimum(np.arange(len(hit)) + width - RUN + 1, len(hit))] - total[:len(hit)] >= least)
        np.add.at(live, start, 1)
        np.subtract.at(live, np.minimum(start + width, len(symbol)), 1)
    place = np.flatnonzero((np.cumsum(live)[:-1] > 0) & (symbol != PAD))
    return place, np.concatenate([[0], np.flatnonzero(np.diff(place) > 1) + 1]) if len(place) else np.zeros(0, np.int64)


def compact(symbol: np.ndarray, place: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kept words, each stretch followed by one PAD; offsets of the
    stretches, and the original place of each word."""
    n = len(begin)
    cut = np.append(begin, len(place)) + np.arange(n + 1)
    of = np.repeat(np.arange(n), np.diff(np.append(begin, len(place))))
    out, origin = np.zeros(len(place) + n, np.uint64), np.zeros(len(place) + n, np.int64)
    at = np.arange(len(place)) + of
    out[at], origin[at] = symbol[place], place
    return out, cut, origin


def member(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)] == keys


class KeyFilter:
    """Which keys are among a table's: a bitmap of fixed size, and up to
    EXACT_KEYS the keys themselves."""

    def __init__(self, keys: DataFrame, column: str):
        held = keys.select(F.col(column).alias("k")).where("k is not null").distinct()
        self.exact = None
        if held.limit(EXACT_KEYS + 1).count() <= EXACT_KEYS:
            self.exact = np.sort(np.array([r.k for r in held.toLocalIterator()], np.int64)).view(np.uint64)
            self.exact.sort()
            top = (self.exact >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
        else:                                              # at most 2^BITMAP_BITS numbers
            top = np.array([r.k for r in held.select(F.shiftrightunsigned("k", 64 - BITMAP_BITS).alias("k")).distinct().toLocalIterator()], np.int64)
        present = np.zeros(1 << BITMAP_BITS, bool)
        present[top] = True
        self.packed = np.packbits(present)

    def open(self) -> KeyFilter:
        """With the bitmap unpacked, in a task."""
        self.bitmap = np.unpackbits(self.packed).view(bool)
        return self

    def __getstate__(self) -> dict:
        return {"exact": self.exact, "packed": self.packed}

    def places(self, keys: np.ndarray) -> np.ndarray:
        hit = np.flatnonzero(self.bitmap[(keys >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)])
        return hit if self.exact is None else hit[member(self.exact, keys[hit])]


def edit_distance_inside(item: np.ndarray, region: np.ndarray) -> int:
    """Least edit distance of the item to any substring of the region
    (bit-parallel, one word of the region a step)."""
    m = len(item)
    if not m:
        return 0
    where: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        where[w] = where.get(w, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for w in region.tolist():
        eq = where.get(w, 0)
        x = eq | minus
        d = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (~(d | plus) & full)
        down = plus & d
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (~(x | up) & full), up & x
        best = min(best, score)
    return best


def size_class(n: int) -> int:
    return int(np.searchsorted(SIZES, n, "right")) - 1


def item_keys(items: DataFrame, repeats: dict[int, int], *, id_col: str, text: str, max_share: float) -> DataFrame:
    """(key, item, words, edits): the keys of every item of at least SIZES[0]
    words, and of shorter ones the hash of all their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            symbol, cut = word_symbols(buf, off)
            ids, out = rows.column(0), []
            for i in range(rows.num_rows):
                own = symbol[cut[i]:cut[i + 1]]            # with its PAD
                c = size_class(len(own) - 1)
                if c < 0:
                    if len(own) > SHORT:
                        out.append((int(window_hashes(own[:-1], len(own) - 1).view(np.int64)[0]), i, own[:-1].tobytes(), 0))
                    continue
                for r in range(repeats[c]):
                    for _, _, key in walk_keys(own, r, [c], np.array([offset(r, c)])):
                        out.append((int(key.view(np.int64)[0]), i, own[:-1].tobytes(), int(max_share * (len(own) - 1))))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), ids.take(pa.array([o[1] for o in out], pa.int64())), pa.array([o[2] for o in out], pa.binary()), pa.array([o[3] for o in out], pa.int64())],
                                             names=["key", "item", "words", "edits"])

    kind = items.select(id_col).schema[0].dataType.simpleString()
    return items.select(items[id_col].alias("item"), items[text].alias("__text")).mapInArrow(run, f"key bigint, item {kind}, words binary, edits bigint")


def item_runs(keys: DataFrame) -> DataFrame:
    """(run): the hashed RUN-word windows of all items that walks look for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(w, np.uint64) for w in batch.column(0).to_pylist()]
            found = [window_hashes(w, RUN) for w in own if len(w) >= SIZES[0]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64), pa.int64())], names=["run"])

    return keys.select("words").distinct().mapInArrow(run, "run bigint").distinct()


def edited(own: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many random replacements, insertions and deletions."""
    out = own.tolist()
    for _ in range(edits):
        kind, at = int(rng.integers(3)), int(rng.integers(len(out)))
        if kind == 0:
            out[at] = int(rng.integers(1, 1 << 62)) * 2 + 1
        elif kind == 1:
            out.insert(at, int(rng.integers(1, 1 << 62)) * 2 + 1)
        elif len(out) > 1:
            del out[at]
    return np.array(out, np.uint64)


def found_by(own: np.ndarray, other: np.ndarray, edits: int, repeats: int) -> np.ndarray:
    """Which repeats find an item in its edited copy, from starts up to
    ``edits`` words around."""
    c, out = size_class(len(own)), np.zeros(repeats, bool)
    own, other = np.append(own, PAD), np.append(other, PAD)
    for r in range(repeats):
        o = offset(r, c)
        wanted = next(walk_keys(own, r, [c], np.array([o])))[2][0]
        starts = np.arange(max(0, o - edits), min(o + edits + 1, len(other)))
        out[r] = bool(len(starts)) and bool((next(walk_keys(other, r, [c], starts))[2] == wanted).any())
    return out


def calibration(items: DataFrame, most: int, scratch: Scratch, *, text: str) -> DataFrame:
    """(words): of each size class, up to ``most`` distinct items chosen by hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            symbol, cut = word_symbols(buf, off)
            own = [symbol[a:b - 1] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([size_class(len(w)) for w in own], pa.int64()), pa.array([w.tobytes() for w in own], pa.binary())], names=["c", "words"])

    found = scratch.save(items.select(items[text].alias("__text")).mapInArrow(run, "c bigint, words binary").where("c >= 0").distinct(), "items")
    parts = [found.where(F.col("c") == c).orderBy(F.xxhash64("words"), "words").limit(most) for c in range(len(SIZES))]
    return reduce(DataFrame.unionByName, parts).select("words")


def found_together(pairs: list[tuple[np.ndarray, np.ndarray, int]], c: int, repeat: int) -> np.ndarray:
    """``found_by`` of one repeat for many (item, copy, edits) of one size class."""
    cut = [np.concatenate([[0], np.cumsum([len(p[k]) + 1 for p in pairs])]) for k in range(2)]
    own, other = (np.concatenate([x for p in pairs for x in (p[k], [PAD])]).astype(np.uint64) for k in range(2))
    o, out = offset(repeat, c), np.zeros(len(pairs), bool)
    wanted = [key for _, _, key in walk_keys(own, repeat, [c], cut[0][:-1] + o)][0]      # an item has o words at least: no walks meet
    starts = np.concatenate([np.arange(a + max(0, o - k), min(a + o + k + 1, b)) for a, b, (_, _, k) in zip(cut[1][:-1], cut[1][1:], pairs)])
    _, first, key = next(walk_keys(other, repeat, [c], starts))
    of = np.searchsorted(cut[1], first, "right") - 1
    out[of[key == wanted[of]]] = True
    return out


def repeats_for(items: list[np.ndarray], share: float, recall: float, draws: int = 400, most: int = MOST_REPEATS) -> int:
    """The least number of repeats with which the wanted share of items is
    found, in every size class, after ``share`` of their words (one at least)
    were edited; ValueError if ``most`` do not reach it."""
    return max([2, *repeats_by_class(items, share, recall, draws, most).values()])


def repeats_by_class(items: list[np.ndarray], share: float, recall: float, draws: int = 400, most: int = MOST_REPEATS) -> dict[int, int]:
    """The same for each size class that has items, from ``draws`` edited
    copies of a class (one of each item at least)."""
    rng, out = np.random.default_rng(3), {}
    for c in sorted({size_class(len(own)) for own in items} - {-1}):
        mine = [own for own in items if size_class(len(own)) == c]
        edits = [max(1, int(share * len(own))) for own in mine]
        pairs = [(own, edited(own, k, rng), k) for own, k in zip(mine, edits) for _ in range(-(-draws // len(mine)))]
        found, n = np.zeros(len(pairs), bool), 0
        while n < 2 or found.mean() < recall:
            if n == most:
                raise ValueError(f"items of {SIZES[c]} words and more: {most} walks find {found.mean():.3f} of the copies with {share:g} of their words edited; recall={recall:g} is asked for")
            found |= found_together(pairs, c, n)
            n += 1
        out[c] = n
    return out


def find_matches(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 max_share: float = 0.2, recall: float = 0.99, calibration_items: int = 48) -> DataFrame:
    """(id, item, distance): items found in each document.

    Matches have up to ``max_share`` of the item's words edited.  ``recall``
    holds for copies with that many edits, in each size class, as measured on
    at most ``calibration_items`` distinct items of the class; unedited ones
    are always found."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontaminate")
    own = [np.frombuffer(r.words, np.uint64) for r in calibration(items, calibration_items, scratch, text=item_text).toLocalIterator()]
    repeats = repeats_by_class(own, max_share, recall)
    keys = scratch.save(item_keys(items, repeats, id_col=item_id, text=item_text, max_share=max_share), "item-keys")
    n_keys = keys.count()
    sizes = [r.n for r in keys.select((F.length("words") / 8).cast("int").alias("n")).distinct().toLocalIterator()]      # lengths of items
    classes = sorted({size_class(n) for n in sizes} - {-1})
    longest = max(sizes, default=0)
    short = sorted(n for n in sizes if n < SIZES[0])
    # of each class: the widest match, and how many windows the item that keeps fewest shares with it
    needs = [(max(n + int(max_share * n) for n in own), min(shared_windows(n, int(max_share * n)) for n in own))
             for own in ([n for n in sizes if size_class(n) == c] for c in classes)]
    runs = scratch.save(item_runs(keys), "runs")
    shared = spark.sparkContext.broadcast((KeyFilter(keys, "key"), KeyFilter(runs, "run")))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_key, by_run = (f.open() for f in shared.value)
        for rows, buf, off in blocks(batches, "__text"):
            whole, rows_cut = word_symbols(buf, off)
            regions, keys_, at = [], [], []
            for n in short:
                value = window_hashes(whole, n)
                hit = by_key.places(value)
                hit = hit[value[hit] != PAD]
                regions += [whole[a:a + n].tobytes() for a in hit.tolist()]
                keys_.append(value[hit])
                at.append(hit)
            value = window_hashes(whole, RUN)
            hits = np.zeros(len(value), bool)
            hits[by_run.places(value)] = True
            symbol, cut, origin = compact(whole, *stretches(whole, hits & (value != PAD), needs))
            found = []
            for r in range(max((repeats[c] for c in classes), default=0) if len(symbol) else 0):
                for c, first, key in walk_keys(symbol, r, [c for c in classes if r < repeats[c]]):
                    hit = by_key.places(key)
                    last = np.where(hit + 1 < len(first), first[np.minimum(hit + 1, len(first) - 1)], len(symbol)) - 1
                    size = SIZES[c + 1] if c + 1 < len(SIZES) else longest
                    reach = int(max_share * size) + 1
                    found.append((first[hit] - reach - offset(r, c), last + size + reach, key[hit], first[hit]))
            if found:
                lo, hi, key, start = (np.concatenate([f[k] for f in found]) for k in range(4))
                own = np.searchsorted(cut, start, "right") - 1
                live = symbol[start] != PAD
                lo, hi = np.maximum(lo, cut[own])[live], np.minimum(hi, cut[own + 1] - 1)[live]
                regions += [symbol[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist())]
                keys_.append(key[live])
                at.append(origin[start[live]])
            if not regions:
                continue
            row = np.searchsorted(rows_cut, np.concatenate(at), "right") - 1
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), pa.array(np.concatenate(keys_).view(np.int64)), pa.array(regions, pa.binary())], names=["id", "key", "region"])

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, distance = [], []
            for i, (w, region, edits) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                d = edit_distance_inside(np.frombuffer(w, np.uint64), np.frombuffer(region, np.uint64))
                if d <= edits:
                    kept.append(i)
                    distance.append(d)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(distance, pa.int64())], names=["id", "item", "distance"])

    kinds = documents.select(id_col).schema[0].dataType.simpleString(), items.select(item_id).schema[0].dataType.simpleString()
    windows = documents.select(documents[id_col].alias("id"), documents[text].alias("__text")).mapInArrow(candidates, f"id {kinds[0]}, key bigint, region binary")
    both = windows.join(sized(keys, n_keys * 8), "key").select("id", "item", "words", "region", "edits")
    return both.mapInArrow(confirm, f"id {kinds[0]}, item {kinds[1]}, distance bigint").groupBy("id", "item").agg(F.min("distance").alias("distance"))


def mark_documents(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, contaminated, n_items, items) per row; ``items`` lists the matched
    item ids, ascending."""
    scratch = Scratch(documents.sparkSession, "decontaminate")
    found = find_matches(documents, items, id_col=id_col, **options)
    found = scratch.save(found.groupBy(F.col("id").alias("__id")).agg(F.array_sort(F.collect_list("item")).alias("items")), "matches")
    out = documents.select(id_col).join(sized(found, found.count() * 4), F.col(id_col).eqNullSafe(F.col("__id")), "left")
    return out.select(id_col, F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce(F.col("items"), F.array().cast(found.schema["items"].dataType)).alias("items"))


def drop_contaminated(documents: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows whose id has no match, all columns."""
    scratch = Scratch(documents.sparkSession, "decontaminate")
    found = scratch.save(find_matches(documents, items, id_col=id_col, **options).select(F.col("id").alias("__id")).distinct(), "matches")
    return documents.join(sized(found, found.count()), F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
