"""Token counts of whole texts by a map-side two-tier lookup.

A text is normalised and cut into pre-tokens; the number of tokens of a
pre-token does not depend on its neighbours.  Tier one is a compact table of
frequent pre-tokens with their lengths, broadcast to the tasks.  Tier two is
a cache in each Python worker: pre-tokens that miss tier one are encoded once
per worker by the tokenizer.  No pre-token is ever shuffled.

The table holds what is frequent in a bounded sample of rows.  It is a cache:
its content changes the speed, never a count.

Results: a null text counts as empty (0 bytes, 0 tokens); special strings in
a text count as the library's default has them (one token each); repeated
rows give repeated results; an empty table gives an empty result; columns
other than the two named are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import blocks, strings

#: The pre-token pattern of the tokenizer's file; classes spelt out for the code points below U+0300.
_BELOW = [chr(i) for i in range(0x300)]
_SPACE = "\t-\r \x85\xa0"
_LETTER = "".join(re.escape(c) for c in _BELOW if unicodedata.category(c)[0] == "L")
_NUMBER = "".join(re.escape(c) for c in _BELOW if unicodedata.category(c)[0] == "N")
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")

#: The letter that byte-level vocabularies write for each byte: the byte's own character if it
#: is visible, else the next one from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTER = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class PretokenLengths:
    """Tokens per pre-token: the frequent ones given, the rest encoded on
    demand and kept up to ``cache_size`` entries."""

    def __init__(self, tokenizer_path: str, frequent: dict[str, int], cache_size: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split_special = re.compile("|".join(map(re.escape, special))) if special else None
        self.frequent, self.cache_size = frequent, cache_size
        self.known = dict(frequent)
        self.other: dict[str, int] = {}

    def encode(self, pretoken: str) -> int:
        """Tokens of one pre-token, by the model itself."""
        return len(self.model.tokenize(pretoken.encode().decode("latin-1").translate(_BYTE_LETTER)))

    def learn(self, pretokens: set[str]) -> None:
        missing = pretokens.difference(self.known)
        if len(self.known) + len(missing) > self.cache_size + len(self.frequent):   # keep this block's only
            self.known = self.frequent | {p: self.known[p] for p in pretokens if p in self.known}
        self.known.update({p: self.encode(p) for p in missing})

    def unusual(self, text: str) -> int:
        """Texts with special strings or code points from U+0300: the
        library's own normaliser and splitter, then its model per pre-token."""
        parts = self.split_special.split(text) if self.split_special else [text]
        total = len(parts) - 1
        for part in parts:
            for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part)):
                n = self.other.get(piece)
                if n is None:
                    n = len(self.model.tokenize(piece))
                    if len(self.other) >= self.cache_size:
                        self.other.clear()
                    self.other[piece] = n
                total += n
        return total

    def count(self, texts: list[str], plain: np.ndarray) -> list[int]:
        """Tokens of each text; ``plain`` marks those with code points below U+0300 only."""
        cut = [_PRETOKEN.findall(t.lower()) if ok and "<|" not in t and "İ" not in t else None for t, ok in zip(texts, plain)]
        self.learn(set().union(*(c for c in cut if c)))
        get = self.known.__getitem__
        return [self.unusual(t) if c is None else sum(map(get, c)) for t, c in zip(texts, cut)]


def _plain(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    high = np.concatenate([[0], np.cumsum(buf >= 0xCC)])
    return high[off[1:]] == high[off[:-1]]


_workers: dict[tuple, PretokenLengths] = {}


def _lengths(path: str, packed: tuple[str, bytes], cache_size: int) -> PretokenLengths:
    key = (path, len(packed[0]), hash(packed[0]), cache_size)
    if key not in _workers:
        _workers.clear()
        names = packed[0].split("\n") if packed[0] else []
        _workers[key] = PretokenLengths(path, dict(zip(names, packed[1])), cache_size)
    return _workers[key]


def frequent_pretokens(documents: DataFrame, tokenizer_path: str, text: str, sample_rows: int, table_size: int) -> tuple[str, bytes]:
    """The ``table_size`` most frequent pre-tokens of about ``sample_rows``
    rows, packed as one string and one byte per length.  Each of eight tasks
    sends its most frequent ones to the driver, at most ``8 * table_size / 4``
    rows; nothing is shuffled."""
    total = documents.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    each = table_size // 4

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for _, buf, off in blocks(batches, text):
            for t in strings(buf, off):
                seen.update(_PRETOKEN.findall(t.lower()))
        best = seen.most_common(each)
        yield pa.RecordBatch.from_pydict({"pretoken": pa.array([k for k, _ in best], pa.string()), "n": pa.array([n for _, n in best], pa.int64())})

    chosen = documents.select(text)
    chosen = chosen if share == 1.0 else chosen.sample(share, seed=7)
    seen: Counter[str] = Counter()
    for r in chosen.coalesce(8).mapInArrow(top, "pretoken string, n bigint").collect():
        seen[r.pretoken] += r.n
    best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:table_size]
    encoder = PretokenLengths(tokenizer_path, {}, 0)
    names = [k for k, _ in best if len(k) <= 64]
    lengths = [encoder.encode(p) for p in names]
    kept = [(k, n) for k, n in zip(names, lengths) if n < 256]
    return "\n".join(k for k, _ in kept), bytes(n for _, n in kept)


def count_tokens(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text: str = "text",
                 limit: int = 2048, sample_rows: int = 4_000, table_size: int = 32_768, cache_size: int = 400_000) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""
    spark = documents.sparkSession
    table = spark.sparkContext.broadcast(frequent_pretokens(documents, tokenizer_path, text, sample_rows, table_size))
    schema = documents.select(id_col).schema
    out_type = f"{schema[0].name} {schema[0].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _lengths(tokenizer_path, table.value, cache_size)
        for rows, buf, off in blocks(batches, text):
            n = np.array(lengths.count(strings(buf, off), _plain(buf, off)), np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)],
                                             names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return documents.select(id_col, text).mapInArrow(count, out_type)
