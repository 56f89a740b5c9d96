"""Fill-in-middle transformation by displacement scatter.

A text is cut at two token boundaries into prefix, middle and suffix, which
are written in another order between three sentinels.  No text is sliced or
joined: all texts of a block lie side by side in one byte array, every byte's
output place is its input place plus a shift, and a shift changes at segment
starts only.  So a difference array takes the changes, its cumulative sum is
the shift of every byte, and one numpy scatter writes the whole block.
Restoring finds the sentinels, builds the same shifts from them, and gathers.

Tokens are ``[A-Za-z]+`` or any other single code point, left to right.  The
cuts and the form come from ``sha256("<seed>:<id>")`` (first four groups of 8
hex digits, h1 to h4), so a row gets the same result wherever it is computed:

* the prefix ends after the smaller of ``h1 % (n + 1)`` and ``h2 % (n + 1)``
  tokens, the middle after the larger;
* ``plain`` (the text as it is) where the text is empty, holds a sentinel, or
  ``h3 % 100`` reaches 100 less the plain share;
* else ``spm`` (suffix, prefix, middle) where ``h4 % 100`` is below the spm
  share; else ``psm`` (prefix, suffix, middle).

Rows never meet, so nothing is shuffled and repeated rows stay.  Null texts
count as empty (``plain``); a null id hashes as the empty string.  A text of
any length is one row of one block; memory is a small multiple of the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c as quoted
from .kernels import blocks

SENTINELS = ("<P>", "<S>", "<M>")              # before prefix, suffix and middle; three ASCII bytes each
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
#: Order in which the segments (0 prefix, 1 middle, 2 suffix) are written.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}

_MARK = np.array([list(s.encode()) for s in (SENTINELS[0], SENTINELS[2], SENTINELS[1])], np.uint8)   # by segment
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def unit_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte at which each token starts: a letter that no letter of the same
    row precedes, or the first byte of any other code point."""
    letter = _LETTER[buf]
    after = np.zeros(len(buf), bool)
    after[1:] = letter[:-1]
    after[off[:-1][off[:-1] < len(buf)]] = False
    return np.flatnonzero(np.where(letter, ~after, (buf & 0xC0) != 0x80))


def marks(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte of every sentinel in the block, and the segment it announces.
    A sentinel across two rows is found too; callers compare row ends."""
    if len(buf) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero((buf[:-2] == _MARK[0, 0]) & (buf[2:] == _MARK[0, 2]))
    which = np.full(256, -1)
    which[_MARK[:, 1]] = (0, 1, 2)
    kind = which[buf[at + 1]]
    return at[kind >= 0], kind[kind >= 0]


def rows_with_marks(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    found = np.zeros(len(off) - 1, bool)
    at, _ = marks(buf)
    row = np.searchsorted(off, at, "right") - 1
    found[row[at + 3 <= off[row + 1]]] = True
    return found


def _shifts(n: int, at: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Shift of each of ``n`` bytes: the changes at ``at`` (several may meet
    where a segment is empty), summed from the left."""
    diff = np.zeros(n + 1, np.int64)
    np.add.at(diff, at, change)
    return np.cumsum(diff[:-1])


def _places(off: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment starts in the input (rows x 3), their starts in the output,
    the sentinels' places in the output, and the rows' output offsets."""
    start = np.stack([off[:-1], cuts[:, 0], cuts[:, 1]], 1)
    size = np.stack([cuts[:, 0] - off[:-1], cuts[:, 1] - cuts[:, 0], off[1:] - cuts[:, 1]], 1)
    out_off = np.concatenate([[0], np.cumsum(np.diff(off) + np.where(form == PLAIN, 0, 9))])
    to, mark = start - off[:-1, None] + out_off[:-1, None], np.full(start.shape, -1)
    for kind, order in ORDER.items():
        own = np.flatnonzero(form == kind)
        at = out_off[own]
        for segment in order:
            mark[own, segment], to[own, segment] = at, at + 3
            at = at + 3 + size[own, segment]
    return start, to, mark, out_off


def scatter(buf: np.ndarray, off: np.ndarray, cuts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and row offsets of a block, given each row's two cuts
    (bytes of the block) and its form."""
    start, to, mark, out_off = _places(off, cuts, form)
    shift = (to - start).ravel()
    moved = _shifts(len(buf), start.ravel(), np.diff(shift, prepend=0))
    out = np.empty(int(out_off[-1]), np.uint8)
    out[np.arange(len(buf)) + moved] = buf
    for segment in range(3):
        own = mark[:, segment][mark[:, segment] >= 0]
        out[own[:, None] + np.arange(3)] = _MARK[segment]
    return out, out_off


def gather(out: np.ndarray, out_off: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and row offsets from a block of outputs and their forms: the
    inverse of ``scatter``, from the sentinels it finds."""
    at, segment = marks(out)
    row = np.searchsorted(out_off, at, "right") - 1
    own = (at + 3 <= out_off[row + 1]) & (form[row] != PLAIN)
    at, segment, row = at[own], segment[own], row[own]
    moved = np.flatnonzero(form != PLAIN)
    if not np.array_equal(row, np.repeat(moved, 3)) or (np.sort(segment.reshape(-1, 3), 1) != np.arange(3)).any():
        raise ValueError("an output has not the three sentinels of its form")
    off = np.concatenate([[0], np.cumsum(np.diff(out_off) - np.where(form == PLAIN, 0, 9))])
    source = np.repeat(out_off[:-1, None], 3, 1)                     # of each segment in the output
    size = np.zeros(source.shape, np.int64)
    size[:, 0] = np.diff(out_off)                                    # plain: all of the row is its prefix
    end = at.reshape(-1, 3)
    end = np.concatenate([end[:, 1:], out_off[moved + 1][:, None]], 1).ravel()
    source[row, segment], size[row, segment] = at + 3, end - at - 3
    start = off[:-1, None] + np.concatenate([np.zeros((len(size), 1), np.int64), np.cumsum(size, 1)[:, :2]], 1)
    shift = (source - start).ravel()
    n = int(off[-1])
    return out[np.arange(n) + _shifts(n, start.ravel(), np.diff(shift, prepend=0))], off


def _code_points(buf: np.ndarray) -> np.ndarray:
    """Code points that start before each byte, 0..len."""
    return np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])


def _draws(id_col: str, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"__h{k + 1}") for k in range(4)]


def _text(buf: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(buf)]).cast(pa.string())


def fill_in_middle(documents: DataFrame, *, id_col: str = "doc_id", text: str = "text", seed: int = 1,
                   plain_percent: int = 10, spm_percent: int = 20, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (the id by default) of every row, then ``n`` tokens,
    ``form``, ``prefix_chars`` and ``middle_chars`` (code points, null for
    plain) and ``output``."""
    keep = [id_col] if keep is None else keep
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    if set(made) & {c.lower() for c in keep}:
        raise ValueError(f"a kept column has the name of a result column: {made}")
    fields = documents.select([quoted(c) for c in keep]).schema
    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n bigint", "form string", "prefix_chars bigint", "middle_chars bigint", "output string"])
    k = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text"):
            h = [np.asarray(rows.column(k + i)).astype(np.int64) for i in range(4)]
            units = unit_starts(buf, off)
            first = np.searchsorted(units, off)                       # of each row's units
            n = np.diff(first)
            form = np.where(h[3] % 100 < spm_percent, SPM, PSM)
            form[(n == 0) | rows_with_marks(buf, off) | (h[2] % 100 >= 100 - plain_percent)] = PLAIN
            ends = np.append(units, len(buf))
            drawn = np.sort(np.stack([h[0] % (n + 1), h[1] % (n + 1)], 1), 1)
            cuts = np.where(drawn == n[:, None], off[1:, None], ends[np.minimum(first[:-1, None] + drawn, len(units))])
            cuts[form == PLAIN] = off[1:][form == PLAIN][:, None]
            points = _code_points(buf)
            plain = form == PLAIN
            out, out_off = scatter(buf, off, cuts, form)
            yield pa.RecordBatch.from_arrays([
                *rows.columns[:k], pa.array(n, pa.int64()), pa.array(np.array(FORMS, object)[form], pa.string()),
                pa.array(points[cuts[:, 0]] - points[off[:-1]], pa.int64(), mask=plain),
                pa.array(points[cuts[:, 1]] - points[cuts[:, 0]], pa.int64(), mask=plain),
                _text(out, out_off)], names=[*keep, *made])

    taken = documents.select(*[quoted(c).alias(f"__k{i}") for i, c in enumerate(keep)], *_draws(id_col, seed), quoted(text).alias("__text"))
    return taken.mapInArrow(run, out_type)


def restore(transformed: DataFrame, *, output: str = "output", form: str = "form", restored: str = "restored") -> DataFrame:
    """The rows of ``fill_in_middle`` with the text rebuilt from ``output``
    and ``form`` alone, in place of ``output``.  An output without the three
    sentinels of its form is an error."""
    names = [c for c in transformed.columns if c != output]
    fields = transformed.select([quoted(c) for c in names]).schema
    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{restored}` string"])
    at = names.index(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__output"):
            kinds = np.array([FORMS.index(f) for f in rows.column(at).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*rows.columns[:len(names)], _text(*gather(buf, off, kinds))], names=[*names, restored])

    return transformed.select(*[quoted(c).alias(f"__k{i}") for i, c in enumerate(names)], quoted(output).alias("__output")).mapInArrow(run, out_type)


def digests(transformed: DataFrame) -> DataFrame:
    """SHA-256 of the output and of the text restored from it."""
    hashed = restore(transformed.withColumn("output_sha256", F.sha2(F.col("output").cast("binary"), 256)))
    return hashed.withColumn("restored_sha256", F.sha2(F.col("restored").cast("binary"), 256)).drop("restored")


def oracle_sql(*, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> str:
    """DuckDB SQL for ``digests(fill_in_middle(documents))``."""
    p, s, m = (f"'{x}'" for x in SENTINELS)
    h = ", ".join(f"('0x' || substr(d, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, {h} FROM hashed),
cut AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, {p}) OR contains(t, {s}) OR contains(t, {m}) OR h3 % 100 >= {100 - plain_percent} THEN 'plain'
              WHEN h4 % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS a,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS b,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS c
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(a) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || a || {s} || c || {m} || b
              ELSE {s} || c || {p} || a || {m} || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut"""
