"""Statistics of whole texts, computed for all rows of a block at once."""

from __future__ import annotations

import numpy as np

from .kernels import SEPARATOR, SpanHash, count_per_row, mix, per_row, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True

FEATURES = ("log_words", "mean_word", "std_word", "symbol_share", "upper_share", "digit_share", "punct_share", "bang_share",
            "high_share", "space_share", "dup_line_share", "repeat_share", "distinct_share", "top_word_share", "same_next_share",
            "bare_word_share", "caps_word_share", "stop_word_share", "line_words", "long_word_share", "byte_entropy", "capital_word_share")


def _repeats(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs elsewhere too, and how often in all."""
    order = np.argsort(key, kind="stable")
    found = key[order]
    new = np.concatenate([[True], found[1:] != found[:-1]]) if len(key) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    size = np.bincount(group) if len(key) else np.zeros(0, np.int64)
    n = np.empty(len(key), np.int64)
    n[order] = size[group]
    first = np.zeros(len(key), bool)
    first[order[new]] = True
    return first, n


def base(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Exact counts per row (words are runs without ASCII white space):
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; and the words
    themselves under names that begin with an underscore."""
    rows = len(off) - 1
    start, end, row = words(buf, off)
    hashes = SpanHash(buf)
    word = hashes(start, end)
    salt = mix(np.arange(1, rows + 1, dtype=np.uint64))
    # words in three-word windows found at least twice in their text
    covered = np.zeros(len(word), bool)
    if len(word) >= 3:
        window = mix(word[:-2] + mix(word[1:-1] + mix(word[2:])))
        at = np.flatnonzero(row[:-2] == row[2:])
        _, n = _repeats(window[at] ^ salt[row[at]])
        again = at[n > 1]
        covered[again] = covered[again + 1] = covered[again + 2] = True
    # lines with a word that equal an earlier line
    newline = np.flatnonzero(buf == 10)
    line_start = np.unique(np.concatenate([off[:-1], newline + 1]))
    line_start = line_start[line_start < len(buf)]
    line_row = np.searchsorted(off, line_start, "right") - 1
    line_end = np.minimum(np.append(line_start[1:], len(buf)), off[line_row + 1]) if len(line_start) else line_start
    line_end = line_end - ((line_end > line_start) & (buf[np.maximum(line_end - 1, 0)] == 10)) if len(line_start) else line_end
    with_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_start, line_end, line_row = line_start[with_word], line_end[with_word], line_row[with_word]
    first, _ = _repeats(hashes(line_start, line_end) ^ salt[line_row]) if len(line_start) else (np.zeros(0, bool), None)
    return {
        "n_words": np.bincount(row, minlength=rows),
        "word_chars": count_per_row(((buf & 0xC0) != 0x80) & ~SEPARATOR[buf], off),
        "n_symbols": count_per_row(_SYMBOL[buf], off),
        "n_dup_lines": np.bincount(line_row[~first], minlength=rows),
        "n_repeat_words": np.bincount(row[covered], minlength=rows),
        "_n_lines": np.bincount(line_row, minlength=rows), "_start": start, "_end": end, "_row": row, "_hash": word, "_salt": salt,
    }


def features(buf: np.ndarray, off: np.ndarray, found: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """One row of FEATURES per text; all zero for a text without words."""
    s = base(buf, off) if found is None else found
    rows = len(off) - 1
    start, end, row, word = s["_start"], s["_end"], s["_row"], s["_hash"]
    n = np.maximum(s["n_words"], 1).astype(float)
    size = np.maximum(np.diff(off), 1).astype(float)
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    length = (lead[end] - lead[start]).astype(float)
    mean = np.bincount(row, length, rows) / n
    spread = np.sqrt(np.maximum(np.bincount(row, length * length, rows) / n - mean * mean, 0))
    share = lambda mask: count_per_row(mask, off) / size
    of_words = lambda mask: np.bincount(row[mask], minlength=rows) / n
    first, count = _repeats(word ^ s["_salt"][row])
    top = np.zeros(rows)
    np.maximum.at(top, row[first], count[first])
    same_next = np.zeros(len(word), bool)
    same_next[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    total = lambda mask: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(mask)]))
    letters = _UPPER[buf] | _LOWER[buf] | (buf >= 0x80)
    upper, small, letter = total(_UPPER[buf]), total(_LOWER[buf]), total(letters)
    # entropy of the bytes of each text
    bounds = np.repeat(np.arange(rows), np.diff(off))
    table = np.bincount(bounds * 256 + buf, minlength=rows * 256).reshape(rows, 256) / size[:, None]
    entropy = -(table * np.log2(np.where(table > 0, table, 1))).sum(1)
    out = np.stack([
        np.log1p(s["n_words"]), mean, spread, share(_SYMBOL[buf]), share(_UPPER[buf]), share(_DIGIT[buf]), share(_PUNCT[buf]),
        share(buf == 33), share(buf >= 0x80), share(SEPARATOR[buf]), s["n_dup_lines"] / np.maximum(s["_n_lines"], 1), s["n_repeat_words"] / n,
        np.bincount(row[first], minlength=rows) / n ** 0.8, top / n, of_words(same_next), of_words(letter == 0),
        of_words((upper > 1) & (small == 0)), of_words(_STOP[buf[end - 1]] if len(end) else np.zeros(0, bool)), n / np.maximum(s["_n_lines"], 1),
        of_words(length > 15), entropy, of_words(_UPPER[buf[start]] if len(start) else np.zeros(0, bool)),
    ], axis=1)
    out[s["n_words"] == 0] = 0
    return out


def words_of_row(found: dict[str, np.ndarray], rows: int) -> np.ndarray:
    return per_row(found["_row"], rows)
