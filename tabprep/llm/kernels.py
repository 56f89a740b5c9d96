"""Vectorised text kernels shared by the operators.

Everything works on the UTF-8 bytes of an Arrow string column: one flat
``uint8`` array and the row offsets, cut into blocks of bounded size so that
the temporaries of a task stay small whatever the batch holds.  A single
row larger than the block size forms a block of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)          # odd, so it has an inverse mod 2^64
_BASE2 = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a 64-bit value over all its bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


# random-looking 64-bit value per byte
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0..n; grown when needed."""
    got = _powers.get(int(base))
    if got is None or len(got[0]) <= n:
        size = max(BLOCK_BYTES + 1, n + 1)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        got = _powers[int(base)] = (np.cumprod(up), np.cumprod(down))
        if size > 4 * BLOCK_BYTES:             # do not keep tables made for one huge row
            _powers.pop(int(base))
    return got


class SpanHash:
    """Hashes of any byte span of one block, from prefix sums of a polynomial
    modulo 2^64.  ``second=True`` uses another base; together they give 128 bits."""

    def __init__(self, buf: np.ndarray, second: bool = False):
        self.up, self.down = _power_tables(_BASE2 if second else _BASE, len(buf))
        self.prefix = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * self.up[:len(buf)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.prefix[end] - self.prefix[start]) * self.down[start]
        return mix(value + (np.asarray(end) - np.asarray(start)).astype(np.uint64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]] if len(offsets) else raw, (offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64))


#: What a Python worker keeps between tasks, by (operator, key).  Workers are
#: reused by the stages that follow, so a task of another operator frees it.
_kept: dict[tuple[str, str], object] = {}
_open = 0


def kept(owner: str, key: str, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once in this worker while ``owner``'s tasks run."""
    if (owner, key) not in _kept:
        _kept[owner, key] = make()
    return _kept[owner, key]


_M_TRIM_THRESHOLD, _M_MMAP_THRESHOLD = -1, -3       # fixed values of mallopt
_steady = False


def _allocator(call: str, *args: int) -> None:
    try:
        getattr(ctypes.CDLL(None), call)(*args)
    except (AttributeError, OSError):             # an allocator without it
        pass


def steady() -> None:
    """Arrays of 1 MB and more go back to the system when they are freed.  By
    default the limit rises with the largest array freed, so that a worker
    that waits for its next task would hold what its last block took."""
    global _steady
    if not _steady:
        _allocator("mallopt", _M_MMAP_THRESHOLD, 1 << 20)
        _allocator("mallopt", _M_TRIM_THRESHOLD, 1 << 22)
        _steady = True


def tidy() -> None:
    """Give back what a finished task no longer needs: arrays freed by numpy
    and Arrow stay in their allocators and would add up over the stages."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    _allocator("malloc_trim", 0)


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES, owner: str = "") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches by text size: (rows, bytes, offsets) of at most ``limit``
    bytes of text, or of one row.  Frees what operators other than ``owner``
    keep, and tidies up at the end of the partition."""
    global _open
    steady()
    for own in [k for k in _kept if k[0] != owner] if not _open else ():
        del _kept[own]
    _open += 1
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            buf, off = flat(batch.column(batch.schema.get_field_index(text)))
            row = 0
            while row < batch.num_rows:
                end = int(np.searchsorted(off, off[row] + limit, "right")) - 1
                end = min(max(end, row + 1), batch.num_rows, row + 65_536)
                yield batch.slice(row, end - row), buf[off[row]:off[end]], off[row:end + 1] - off[row]
                row = end
            batch = buf = off = None              # before the next batch is read
    finally:
        _open -= 1
        if not _open:
            tidy()


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs without ASCII white space, never across rows:
    start and end byte of each word, and its row."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SEPARATOR[buf]
    first = np.ones(len(buf), bool)
    first[1:] = ~inside[:-1]
    first[off[:-1][off[:-1] < len(buf)]] = True
    start = np.flatnonzero(inside & first)
    last = np.ones(len(buf), bool)
    last[:-1] = first[1:] | ~inside[1:]
    end = np.flatnonzero(inside & last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def per_row(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Offsets of each row's items, given the ascending row of each item."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def count_per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many bytes of each row the mask marks."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def shingle_hashes(word_hash: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, and its row.  A row
    with fewer words (one at least) has its whole sequence as one shingle."""
    bounds = per_row(row, n_rows)
    count = np.diff(bounds)
    n = len(word_hash)
    value = np.zeros(max(n - size + 1, 0), np.uint64)
    for k in range(size if n >= size else 0):
        value += word_hash[k:n - size + 1 + k] * np.uint64(pow(int(_BASE2), k, 1 << 64))
    whole = row[:len(value)] == row[size - 1:] if n >= size else np.zeros(0, bool)
    hashes, rows = mix(value[whole]), row[:len(value)][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, r in enumerate(short):
            own = word_hash[bounds[r]:bounds[r + 1]]
            extra[i] = mix((own * _power_tables(_BASE, len(own))[0][:len(own)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(own)))[0]
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def distinct_per_row(value: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and the offsets of the rows."""
    bounds, parts, off = per_row(row, n_rows), [], np.zeros(n_rows + 1, np.int64)
    for r in range(n_rows):
        own = np.sort(value[bounds[r]:bounds[r + 1]])
        if len(own) > 1:
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        parts.append(own)
        off[r + 1] = off[r] + len(own)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), off


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles (A-Z lower-cased) of each row: sorted hashes and offsets."""
    low = LOWER[buf]
    start, end, row = words(low, off)
    hashed = SpanHash(low)(start, end) if len(start) else np.zeros(0, np.uint64)
    value, rows = shingle_hashes(hashed, row, len(off) - 1, size)
    return distinct_per_row(value, rows, len(off) - 1)


def strings(buf: np.ndarray, off: np.ndarray) -> list[str]:
    raw = buf.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
