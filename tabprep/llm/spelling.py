"""Spelling variants of a corpus' words, found by pivotal grams.

Words one edit apart are found without comparing all words:

* All bigrams have one order, rarest first (by how many there are in each of
  65,536 hash classes, then by the bigram itself).  A word's *prefix* is its
  three first bigrams in that order, with all that tie with the third.
* Its *pivots* are two prefix bigrams that do not overlap, the pair with the
  least sum of frequencies, chosen by dynamic programming over positions.
* One edit leaves one of two disjoint bigrams whole.  Of two near words take
  the one whose third bigram comes first: its whole pivot is then in the other
  word's prefix.  So pivots are looked up among prefix bigrams.
* Position limits: the edit is to the right of the whole pivot or to its left,
  so the words agree from their start through the pivot, or from the pivot to
  their end.  The lookup key is a hash of that side, pivot included, and the
  lengths differ by one at most.
* A crowded key (over ``crowd`` rows) gets a second level: the rest of the
  words, where the edit is, agrees in its first or in its last half, so its
  rows are looked up by the side and a half.  Rows grow by a factor of four,
  not with the square of the key's rows.
* Candidates are verified by their edit distance inside the join condition;
  candidate pairs are never written as rows.

A word has at most (2 * length + 1) * (letters of the alphabet) near words, so
the groups of the later aggregates are bounded.  Nothing but the 65,536 class
counts (fixed size) reaches the driver.

Null texts count as empty, a null id as the empty string; repeated rows count
again; texts are read in pieces cut between words, whole texts in the end.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c as quoted
from .kernels import blocks, mix
from .shared import Scratch

#: Runs of [A-Za-zÀ-ÿ] in lower-cased UTF-8: U+00C0 to U+00FF are C3 and one more byte.
_RUN = re.compile(rb"(?:[a-z]+|\xc3.)+", re.S)
_OUTSIDE = re.compile(rb"[^a-z\x80-\xbf\xc3]")
PIECE_BYTES = 1 << 20
HELD_WORDS = 200_000                                  # counted in a task before they are handed on

CLASSES = 1 << 16
CROWD = 512
_CHUNK = 1 << 19                                      # code points of the words handled at once
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_RIGHT = np.uint64(0x5851F42D4C957F2D)                # sets keys of right sides apart
INDEX = "key bigint, place int, pivot boolean, last bigint, word string, length int, n bigint"


# --- counting -----------------------------------------------------------------

def _pieces(raw: bytes) -> Iterator[bytes]:
    at = 0
    while len(raw) - at > PIECE_BYTES:
        cut = _OUTSIDE.search(raw, at + PIECE_BYTES)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


def _add_words(counts: dict[bytes, int], doc_id: str, raw: bytes, divisor: int, min_chars: int) -> None:
    """Add one text's words to ``counts``; ``raw`` is its UTF-8."""
    own: Counter[bytes] = Counter()
    for piece in _pieces(raw.lower()):                # bytes.lower changes A-Z alone
        own.update(_RUN.findall(piece))
    begun = zlib.crc32(f"{doc_id}:".encode())
    for word, n in own.items():
        if len(word) < min_chars:
            continue
        length = len(word) - word.count(b"\xc3")
        if length < min_chars:
            continue
        h = zlib.crc32(word, begun)
        if h % divisor == 0:
            if length == min_chars:
                continue
            letters = word.decode()
            word = (letters[:h % length] + letters[h % length + 1:]).encode()
        counts[word] = counts.get(word, 0) + n


def count_words(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", divisor: int = 199,
                min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of all words with ``min_chars`` code points and ``min_count``
    occurrences at least.  Words are maximal runs of ASCII and Latin-1 letters
    with A-Z lower-cased; where ``divisor`` divides h = crc32("<id>:<run>"),
    that document's run loses its code point h % length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for rows, buf, off in blocks(batches, "__text"):
            raw = buf.tobytes()
            for doc_id, a, b in zip(rows.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist()):
                _add_words(counts, doc_id, raw[a:b], divisor, min_chars)
            if len(counts) > HELD_WORDS:
                yield _counted(counts)
                counts = {}
        if counts:
            yield _counted(counts)

    found = documents.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("__id"), quoted(text).alias("__text")).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(counts: dict[bytes, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


# --- pivotal grams ------------------------------------------------------------

def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of words of one length, and their code points as a matrix."""
    length = np.array([len(w) for w in words], np.int64)
    for size in np.unique(length[length > 0]).tolist():
        at = np.flatnonzero(length == size)
        for k in range(0, len(at), max(1, _CHUNK // size)):
            own = at[k:k + max(1, _CHUNK // size)]
            codes = np.frombuffer("".join(words[i] for i in own.tolist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield own, codes.reshape(len(own), size).astype(np.uint64)


def _grams(codes: np.ndarray) -> np.ndarray:
    return codes[:, :-1] << np.uint64(21) | codes[:, 1:]


def _class(grams: np.ndarray) -> np.ndarray:
    return (mix(grams) & np.uint64(CLASSES - 1)).astype(np.int64)


def gram_counts(words: DataFrame) -> np.ndarray:
    """How many bigrams of the words fall into each class: an array of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                total += np.bincount(_class(_grams(codes)).ravel(), minlength=CLASSES)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["class", "n"])

    out = np.zeros(CLASSES, np.int64)
    for r in words.select("word").mapInArrow(run, "class bigint, n bigint").groupBy("class").agg(F.sum("n").alias("n")).collect():   # CLASSES rows at most
        out[r["class"]] = r["n"]
    return out


def prefix_and_pivots(codes: np.ndarray, counts: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words of one length: which bigrams are in the prefix (words x
    positions), the order value of the last of them, and the two pivots.

    The pivots are the cheapest two prefix positions at least two apart:
    ``best[i]`` is the cheapest position up to i, and a second pivot at j costs
    its own frequency and ``best[j - 2]``."""
    grams = _grams(codes)
    kind = _class(grams)
    order = rank[kind] << np.uint64(42) | grams
    last = np.partition(order, 2, axis=1)[:, 2]
    prefix = order <= last[:, None]
    cost = np.where(prefix, counts[kind].astype(float), np.inf)
    best = np.minimum.accumulate(cost, axis=1)
    improves = np.ones(cost.shape, bool)
    improves[:, 1:] = cost[:, 1:] < best[:, :-1]
    where = np.maximum.accumulate(np.where(improves, np.arange(cost.shape[1]), 0), axis=1)
    second = (cost[:, 2:] + best[:, :-2]).argmin(1) + 2
    return prefix, last, np.stack([where[np.arange(len(codes)), second - 2], second], 1)


def _sums(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the inverse powers."""
    size = codes.shape[1]
    up, down = np.full(size, _B), np.full(size + 1, _B_INVERSE)
    up[:1] = down[:1] = 1
    sums = np.zeros((len(codes), size + 1), np.uint64)
    np.cumsum(mix(codes) * np.cumprod(up), axis=1, out=sums[:, 1:])
    return sums, np.cumprod(down)


def _spans(sums: np.ndarray, down: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[row, end] - sums[row, start]) * down[start] + (end - start).astype(np.uint64))


def _batch(arrays: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names)


_NAMES = [f.split()[0] for f in INDEX.split(", ")]


def gram_index(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """Two rows for each prefix bigram of each word: keyed by the word from
    its start through the bigram (``place`` = position), and from the bigram
    to its end (``place`` = -1 - position)."""
    rank = np.empty(CLASSES, np.uint64)
    rank[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0), batch.column(1)
            for own, codes in _by_length(words.to_pylist()):
                if codes.shape[1] < 4:
                    raise ValueError("words of fewer than 4 code points have no two disjoint bigrams in each prefix")
                prefix, last, pivots = prefix_and_pivots(codes, counts, rank)
                row, at = np.nonzero(prefix)
                pivot = (at == pivots[row, 0]) | (at == pivots[row, 1])
                sums, down = _sums(codes)
                size = np.full(len(row), codes.shape[1])
                left, right = _spans(sums, down, row, np.zeros_like(at), at + 2), _spans(sums, down, row, at, size) ^ _RIGHT
                both = np.concatenate([own[row], own[row]])
                yield _batch([np.concatenate([left, right]).view(np.int64), np.concatenate([at, -1 - at]).astype(np.int32), np.concatenate([pivot, pivot]),
                              last[np.concatenate([row, row])].view(np.int64), words.take(pa.array(both)), np.concatenate([size, size]).astype(np.int32), n.take(pa.array(both))], _NAMES)

    return words.select("word", "n").mapInArrow(run, INDEX)


def _halves(rows: DataFrame) -> DataFrame:
    """Rows of crowded keys, keyed by the side and a half of the rest.

    Let m be the shorter of two near words' rests and h = m // 2: an edit at h
    or later leaves the first h code points, an earlier one the last m - h
    (seen from the side that agrees).  A word does not know whether its partner
    is shorter, so it has rows for m = its own rest and for one less."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {name: batch.column(i) for i, name in enumerate(_NAMES)}
            key, place = np.asarray(cols["key"]).view(np.uint64), np.asarray(cols["place"]).astype(np.int64)
            for own, codes in _by_length(cols["word"].to_pylist()):
                at, size = place[own], codes.shape[1]
                from_left = at >= 0
                low, high = np.where(from_left, at + 2, 0), np.where(from_left, size, -1 - at)      # the rest
                sums, down = _sums(codes)
                row, made, taken = np.arange(len(own)), [], []
                for less in (0, 1):
                    m = high - low - less
                    use = np.flatnonzero(m >= 0)
                    h = m[use] // 2
                    a, b = low[use], high[use]
                    near, far = np.where(from_left[use], h, m[use] - h), np.where(from_left[use], m[use] - h, h)
                    for k, (start, end) in enumerate(((a, a + near), (b - far, b))):
                        salt = (m[use] * 2 + k).astype(np.uint64) * _RIGHT
                        made.append(mix(key[own][use] + salt) ^ _spans(sums, down, row[use], start, end))
                        taken.append(own[use])
                if made:
                    at = pa.array(np.concatenate(taken))
                    yield _batch([np.concatenate(made).view(np.int64), *(cols[c].take(at) for c in _NAMES[1:])], _NAMES)

    return rows.mapInArrow(run, INDEX)


def _verified(index: DataFrame) -> DataFrame:
    """(a, an, b, bn) of near words that share a key; a pair may come again.
    The word whose last prefix bigram comes first brings the pivot."""
    p = index.where("pivot").select("key", *(F.col(c).alias(f"p_{c}") for c in ("last", "word", "length", "n")))
    first = (F.col("p_last") < F.col("last")) | ((F.col("p_last") == F.col("last")) & (F.col("p_word") < F.col("word")))
    met = (F.abs(F.col("p_length") - F.col("length")) <= 1) & first
    near = F.levenshtein("p_word", "word", 1) == 1
    return p.join(index.drop("pivot", "place"), (p["key"] == index["key"]) & met & near).select(
        F.col("p_word").alias("a"), F.col("p_n").alias("an"), F.col("word").alias("b"), F.col("n").alias("bn"))


def near_words(words: DataFrame, scratch: Scratch, *, crowd: int = CROWD) -> DataFrame:
    """(a, an, b, bn): every pair of words one edit apart, once, with their
    counts; ``words`` has distinct words and is a saved table."""
    index = scratch.save(gram_index(words, gram_counts(words)), "grams")
    crowded = scratch.save(index.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > crowd).select("key"), "crowded")
    plain = index.join(crowded, "key", "left_anti").select(*_NAMES)
    split = _halves(index.join(crowded, "key", "left_semi").select(*_NAMES))
    return scratch.save(_verified(plain).unionByName(_verified(split)).groupBy("a", "b").agg(F.first("an").alias("an"), F.first("bn").alias("bn")), "near")


# --- forms --------------------------------------------------------------------

def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of words that have a form.  Each form occurs several
    times as often as its word, so chains are short (the logarithm of the
    largest count) and end.  A round keeps only the words still on their way."""
    step = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    on, ended = scratch.save(forms.select("word", F.col("form").alias("root")), "roots"), []
    while True:
        moved = scratch.save(on.join(step, F.col("root") == F.col("at"), "left").select("word", "root", "next"), "roots")
        ended.append(moved.where("next is null").select("word", "root"))
        on = moved.where("next is not null").select("word", F.col("next").alias("root"))
        if on.isEmpty():
            break
    out = ended[0]
    for part in ended[1:]:
        out = out.unionByName(part)
    return out


def variant_forms(words: DataFrame, *, factor: int = 5, crowd: int = CROWD, scratch: Scratch | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a table of distinct words and
    their counts (word, n).  ``form``: the near word with the largest count
    (ties: the smallest by code points) if that is ``factor`` times the word's
    at least; ``root``: where following forms ends."""
    scratch = scratch or Scratch(words.sparkSession, "spelling")
    words = scratch.save(words.select("word", "n"), "words")
    near = near_words(words, scratch, crowd=crowd)
    sides = near.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("bn").alias("near_n")).unionByName(
        near.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("an").alias("near_n")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = F.col("n") * factor <= -F.col("best.less")
    judged = scratch.save(words.join(best, "word", "left").select(
        "word", F.when(found, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(found, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(judged.where("form is not null").select("word", "form"), scratch)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Variant forms of all words of the documents."""
    return variant_forms(count_words(documents, id_col=id_col, text=text))
