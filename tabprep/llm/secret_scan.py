"""Secret scans: fixed base patterns plus a linear-chain conditional random field.

Base patterns find spans of three kinds in the whole text (``assign``: the
value after a password-like keyword; ``access``: access keys; ``hex``: long
hexadecimal runs).  The field tags the tokens of the text as B (a secret
begins), I (inside) or O (outside).  Tokens are runs of letters, digits and
``+/_.-`` and single other characters; features are the token's shape, signs
and mixture of characters, the shapes and hashed names of its neighbours, and
features of the whole text ("file").  Viterbi decodes the best path; tagged runs that do not touch a
base span are added as kind ``crf``.

The field is fitted on windows of a bounded sample (``sample_rows`` distinct
texts with a base span and as many without, at most ``windows`` places in each
copy, drawn by a hash).  Base spans alone would teach it the base patterns, so
its texts get more: copies in which base spans hold other letters, and copies
with made-up lines, half of them secrets of many shapes in contexts that no
base pattern has (other names, headers, command lines, prose, none), half hard
negatives (paths, addresses, ids, hashes of files, base64 prose, identifiers,
numbers).  What the field finds is therefore decided by shape and context
together.  The tests measure it on contexts that are not among these.

Decoding is exact and cheap: a token is fixed to O where no path through B or
I could win, whatever its neighbours; the rest are short runs, decoded
together step by step.

Results: a null or empty text has no spans; without any base span in the
sample no field is fitted and only base spans are returned; equal texts get
equal spans; an empty table gives an empty result; columns other than those
named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, SpanHash, blocks, count_per_row, per_row
from .shared import Scratch, sized

KINDS = ("assign", "access", "hex", "crf")
#: Base patterns, fixed values of the contract: (pattern, group of the span, least length).
BASE = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 6),
    (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    (re.compile(r"[0-9a-f]{24,}"), 0, 24),            # the maximal runs of 24 and more
)
#: Shorter runs tagged by the field are no spans, as for ``assign``.
LEAST_CRF = 6
_KEYWORDS = ("password", "passwd", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind."""
    found = []
    low = text.lower()
    for kind, (pattern, group, least) in enumerate(BASE):
        if kind == 0 and not any(k in low for k in _KEYWORDS) or kind == 1 and "AKIA" not in text:
            continue
        found += [(m.start(group), kind, m.end(group)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(found)


# --- tokens and features ---------------------------------------------------

_RUN = np.zeros(256, bool)
_RUN[[b for b in range(128) if chr(b).isalnum()]] = True
_RUN[list(b"+/_.-")] = True
_RUN[0x80:] = True                                     # letters beyond ASCII belong to words
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.zeros(256, np.uint8)                       # 0 other, 1 lower, 2 upper, 3 digit, 4 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[0x80:] = 1, 2, 3, 4
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True

_SIGNS = (b".", b"/", b"+", b"-_")                     # signs a run may hold
N_SHAPE = 8 * 16 * 2 * 4          # length bucket, classes present, hex only, changes of class
N_NAME = 1 << 12
BLOCK = 1 << 19                   # bytes of text at once: a token has some 200 bytes of features
N_FILE = 4
#: offsets of the feature families in the weight table
OWN, LEFT, RIGHT, NAME1, NAME2, NEXT, FILE, SIZE, TURNS, SIGNS, MIXED, DENSE, AFTER, LONG = np.cumsum([0, N_SHAPE, N_SHAPE, N_SHAPE, N_NAME, N_NAME, N_NAME, N_FILE, 16, 64, 16 * 8, 16 * 16, 8 * 8, 8 * 8 * 4]).tolist()
N_FEATURES, FAMILIES = LONG + 7 * 16 * 16 * 2, 14


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each token."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    run, blank = _RUN[buf], _BLANK[buf]
    first = np.ones(len(buf), bool)
    first[1:] = ~(run[1:] & run[:-1])
    first[off[:-1][off[:-1] < len(buf)]] = True
    start = np.flatnonzero(first & ~blank)
    stop = np.ones(len(buf), bool)
    stop[:-1] = first[1:]
    end = np.flatnonzero(stop & ~blank) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def token_features(buf: np.ndarray, off: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Indices into the weight table, one column per family; -1 for none."""
    n = len(start)
    kind = _CLASS[buf]
    within = lambda mask: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(mask)]))
    length = end - start
    bucket = np.searchsorted([2, 4, 8, 12, 16, 24, 36], length, "right")
    present = sum(((within(kind == k + 1) > 0).astype(np.int64) << k) for k in range(4))
    change = np.zeros(len(buf), bool)
    change[1:] = kind[1:] != kind[:-1]
    # changes of class after the first letter
    changes = within(change) - change[start]
    turns = np.minimum(changes // 2, 3)
    shape = ((bucket * 16 + present) * 2 + (within(_HEX[buf]) == length)) * 4 + turns
    name = (SpanHash(LOWER[buf])(start, end) & np.uint64(N_NAME - 1)).astype(np.int64)
    out = np.full((n, FAMILIES), -1, np.int64)
    out[:, 0] = OWN + shape
    same = row[1:] == row[:-1]
    out[1:, 1] = np.where(same, LEFT + shape[:-1], -1)
    out[:-1, 2] = np.where(same, RIGHT + shape[1:], -1)
    out[1:, 3] = np.where(same, NAME1 + name[:-1], -1)
    out[2:, 4] = np.where(row[2:] == row[:-2], NAME2 + name[:-2], -1)
    out[:-1, 5] = np.where(same, NEXT + name[1:], -1)
    # file: shares of digits and of assignment signs, in four combinations
    size = np.maximum(np.diff(off), 1)
    file = (count_per_row(kind == 3, off) * 50 > size) * 2 + (count_per_row((buf == 61) | (buf == 58), off) * 200 > size)
    out[:, 6] = FILE + file[row]
    out[:, 7] = SIZE + bucket * 2 + (present >> 2 & 1)                # with a digit or not
    out[:, 8] = TURNS + turns * 16 + present
    # signs within the run, with its length and with its classes; and how densely classes change
    signs = np.zeros(n, np.int64)
    for k, which in enumerate(_SIGNS):
        mask = np.zeros(256, bool)
        mask[list(which)] = True
        signs |= (within(mask[buf]) > 0).astype(np.int64) << k
    out[:, 9] = SIGNS + signs * 8 + bucket
    out[:, 10] = MIXED + signs * 16 + present
    out[:, 11] = DENSE + np.minimum(changes * 8 // np.maximum(length, 1), 7) * 8 + bucket
    # long runs apart: secrets are seldom that long
    far = np.searchsorted([24, 44, 64, 96, 160, 256], length, "right")
    out[:, 13] = LONG + ((far * 16 + signs) * 16 + present) * 2 + (within(_HEX[buf]) == length)
    # the length with that of the token before, and how much that one changes
    out[1:, 12] = np.where(same, AFTER + (bucket[1:] * 8 + bucket[:-1]) * 4 + turns[:-1], -1)
    return out


# --- the field -------------------------------------------------------------

@dataclass
class Field:
    weight: np.ndarray            # N_FEATURES x 3 (O, B, I)
    jump: np.ndarray              # 3 x 3, from x to

    def emissions(self, feature: np.ndarray) -> np.ndarray:
        table = np.vstack([self.weight, np.zeros((1, 3), self.weight.dtype)])      # index -1: nothing
        out = table[feature[:, 0]]
        for k in range(1, feature.shape[1]):
            out = out + table[feature[:, k]]
        return out

    def decode(self, emission: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best tags of each row's tokens."""
        tag = np.zeros(len(emission), np.int8)
        if not len(emission):
            return tag
        # what replacing a B or I by O could cost at most in its two transitions
        slack = max(float((self.jump[:, y].max() + self.jump[y, :].max()) - (self.jump[:, 0].min() + self.jump[0, :].min())) for y in (1, 2))
        slack = max(slack, *(float(self.jump[:, y].max() - self.jump[:, 0].min()) for y in (1, 2)), 0.0)
        maybe = np.flatnonzero(emission[:, 1:].max(1) + slack >= emission[:, 0])
        if not len(maybe):
            return tag
        # runs of undecided tokens; an O stands before and after each unless the text ends there
        new = np.concatenate([[True], (np.diff(maybe) != 1) | (row[maybe[1:]] != row[maybe[:-1]])])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(maybe)))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        head, tail = maybe[begin], maybe[begin + length - 1]
        before = (head > 0) & (row[np.maximum(head - 1, 0)] == row[head])
        after = (tail + 1 < len(row)) & (row[np.minimum(tail + 1, len(row) - 1)] == row[tail])
        score = emission[head] + np.where(before[:, None], self.jump[0][None, :], 0.0)
        back = np.zeros((len(maybe), 3), np.int8)
        for t in range(1, int(length[0])):
            live = int(np.searchsorted(-length, -t, "left"))            # runs longer than t
            step = score[:live, :, None] + self.jump[None, :, :]
            back[begin[:live] + t] = step.argmax(1)
            score[:live] = step.max(1) + emission[maybe[begin[:live] + t]]
        last = (score + np.where(after[:, None], self.jump[:, 0][None, :], 0.0)).argmax(1).astype(np.int8)
        for t in range(int(length[0]) - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, "left"))
            tag[maybe[begin[:live] + t]] = last[:live]
            last[:live] = back[begin[:live] + t, last[:live]] if t else last[:live]
        return tag


def fit(windows: list[tuple[np.ndarray, np.ndarray]], *, steps: int = 60, l2: float = 1e-3, rate: float = 0.2) -> Field:
    """Conditional likelihood by forward-backward over all windows at once;
    Adam steps.  windows: (features, tags) of consecutive tokens."""
    feature = np.concatenate([f for f, _ in windows])
    tag = np.concatenate([t for _, t in windows])
    used, at = np.unique(feature, return_inverse=True)
    at = at.reshape(feature.shape).astype(np.int32)
    del feature
    live = used >= 0
    length = np.array([len(t) for _, t in windows])
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    w, j = np.zeros((len(used), 3)), np.zeros((3, 3))
    inner = np.ones(len(tag), bool)
    inner[first] = False
    gold = np.zeros((len(tag), 3))
    gold[np.arange(len(tag)), tag] = 1
    gold_jump = np.zeros((3, 3))
    np.add.at(gold_jump, (tag[np.flatnonzero(inner) - 1], tag[inner]), 1)
    moments = [np.zeros_like(x) for x in (w, w, j, j)]
    n = len(windows)
    logsum = lambda x, axis: (lambda m: m.squeeze(axis) + np.log(np.exp(x - m).sum(axis)))(x.max(axis, keepdims=True))
    alive = [int(np.searchsorted(-length, -t, "left")) for t in range(int(length[0]) + 1)]
    for step in range(1, steps + 1):
        e = w[at[:, 0]]
        for c in range(1, at.shape[1]):
            e += w[at[:, c]]
        a, b = np.zeros_like(e), np.zeros_like(e)
        a[first] = e[first]
        for t in range(1, int(length[0])):
            i = first[:alive[t]] + t
            a[i] = logsum(a[i - 1][:, :, None] + j[None], 1) + e[i]
        for t in range(int(length[0]) - 2, -1, -1):
            i = first[:alive[t + 1]] + t
            b[i] = logsum(j[None] + (e[i + 1] + b[i + 1])[:, None, :], 2)
        total = np.empty(len(tag))
        z = logsum(a[first + length - 1], 1)
        for k, (s, m) in enumerate(zip(first, length)):
            total[s:s + m] = z[k]
        node = np.exp(a + b - total[:, None])
        i = np.flatnonzero(inner)
        edge = np.exp(a[i - 1][:, :, None] + j[None] + (e[i] + b[i])[:, None, :] - total[i][:, None, None]).sum(0)
        error = (node - gold) / n
        grad_w = np.stack([sum(np.bincount(at[:, c], error[:, y], len(used)) for c in range(at.shape[1])) for y in range(3)], 1) + l2 * w
        grad_w[~live] = 0
        grad_j = (edge - gold_jump) / n + l2 * j
        for x, g, k in ((w, grad_w, 0), (j, grad_j, 2)):
            moments[k] += 0.1 * (g - moments[k])
            moments[k + 1] += 0.01 * (g * g - moments[k + 1])
            x -= rate * (moments[k] / (1 - 0.9 ** step)) / (np.sqrt(moments[k + 1] / (1 - 0.99 ** step)) + 1e-8)
    weight = np.zeros((N_FEATURES, 3), np.float32)
    weight[used[live]] = w[live]
    return Field(weight, j.astype(np.float32))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Contexts of made-up secrets; the value stands at {}.
CONTEXTS = ('private_key = "{}"', "auth: {}", "the key is {}", "key: {}", "access_key={}", "login with {} now", "Cookie: session={};", "connect -p {}", '"credential": "{}"',
            "X-Auth-Key: {}", "credentials are {}", "key {}", "<key>{}</key>", "export KEY={}", "sign({})", "code = '{}'", "{}", "use {} to log in", "auth=\"{}\"", "user admin {}", "admin:{}@",
            "{}", "{}", "#w {}", "#w {}", "#w: {}", "#w={}", "#w: #w {}", "#W: #W {}", "#w = '{}'", "\"#w\": \"{}\"", "--#w {}", "#w://#w:{}@#w.#w/#w", "?#w={}&#w=1")      # #w: any word
_WORDS = ("data", "user", "main", "index", "value", "item", "node", "file", "list", "test", "core", "util", "view", "page", "get", "set", "max", "count", "name", "time")


def _letters(rng: np.random.Generator, low: int, high: int, of: str = _LETTERS) -> str:
    return "".join(of[i] for i in rng.integers(0, len(of), int(rng.integers(low, high + 1))))


def made_secret(rng: np.random.Generator) -> str:
    """A value of one of seven shapes."""
    kind = int(rng.integers(7))
    if kind == 0:
        return _letters(rng, 20, 40, "0123456789ABCDEF") if rng.random() < 0.5 else _letters(rng, 12, 23, "0123456789abcdef")
    if kind == 1:
        return _letters(rng, 12, 44)
    if kind == 2:
        return _letters(rng, 20, 62, _LETTERS + "+/") + "=" * int(rng.integers(0, 3))
    if kind == 3:
        return _letters(rng, 16, 48, _LETTERS + "-_")
    if kind == 4:
        return _letters(rng, 2, 4, _LETTERS[26:52]) + ("_" if rng.random() < 0.6 else "-") + _letters(rng, 16, 40)
    if kind == 5:
        return ".".join([_letters(rng, 2, 30), _letters(rng, 16, 60, _LETTERS + "-_"), _letters(rng, 20, 44, _LETTERS + "-_")][int(rng.integers(2)):])
    value = _letters(rng, 8, 14)
    return value if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) else value + "7q"


def _prose(rng: np.random.Generator, n: int) -> str:
    """Words of ASCII letters, in half of the cases of others too."""
    of = _LETTERS[26:52] + ("éüßñçøабвгд日本語" if rng.random() < 0.5 else "")
    return " ".join(_letters(rng, 2, 9, of) for _ in range(n))


def made_harmless(rng: np.random.Generator) -> str:
    """A line that looks technical and holds no secret."""
    word = lambda: _WORDS[int(rng.integers(len(_WORDS)))]
    number = lambda low, high: _letters(rng, low, high, "0123456789")
    hexa = lambda n: _letters(rng, n, n, "0123456789abcdef")
    kind = int(rng.integers(24))
    kind = kind if kind < 20 else (17, 17, 6, 3)[kind - 20]          # the hardest ones more often
    if kind > 15:
        host = f"{word()}{number(0, 2) if rng.random() < 0.5 else ''}.{('net', 'org', 'com', 'io')[int(rng.integers(4))]}"
        if kind == 16:                                # addresses with parameters and numbers
            return f"http{'s' * int(rng.integers(2))}://{host}/" + "/".join(word()[:int(rng.integers(1, 6))] for _ in range(int(rng.integers(0, 4)))) + f"?{word()}={number(1, 4)}&{word()}={word()}"
        if kind == 17:                                # encoded prose in one line
            return base64.b64encode(_prose(rng, int(rng.integers(12, 60))).encode()).decode().rstrip("=" if rng.random() < 0.5 else "")
        if kind == 18:                                # part numbers, versions, file names
            return f"{word()} no. {number(2, 6)}-{number(2, 5)}, {number(1, 2)}.{number(1, 2)}.{number(1, 3)}, {word()}_{number(1, 3)}.{('csv', 'cpp', 'h5', 'tar.gz')[int(rng.integers(4))]}"
        return f"{word()}{word().title()}Of{word().title()}({word()}_{word()}, {_letters(rng, 1, 8, _LETTERS[26:52])}{number(1, 3)}) {host}:{number(2, 5)}"
    if kind == 0:
        return "/".join(["", *(word() for _ in range(int(rng.integers(2, 6))))]) + f"_{word()}." + ("py", "txt", "so", "java")[int(rng.integers(4))]
    if kind == 1:
        return f"https://www.{word()}{word()}.com/{word()}/{number(1, 6)}/{word()}-{word()}.html"
    if kind == 2:
        return ("id: {}", "id={}", "uuid {}", "{}")[int(rng.integers(4))].format("-".join(hexa(n) for n in (8, 4, 4, 4, 12)))
    if kind == 3:
        digest = hexa(int(rng.choice([32, 40, 64, 96, 128]))).upper()
        return ("{0} of {1}.zip {2}", "{0}: {2}", "{0} {2}", "{2}  {1}.tar", "{0}-{2}")[int(rng.integers(5))].format(("sha256", "md5", "checksum", "etag", word())[int(rng.integers(5))], word(), digest)
    if kind == 4:
        return f"20{number(2, 2)}-0{rng.integers(1, 10)}-1{rng.integers(10)}T0{rng.integers(10)}:{rng.integers(10, 60)}:{rng.integers(10, 60)}.{number(3, 6)}Z"
    if kind == 5:
        return f"version v{rng.integers(20)}.{rng.integers(20)}.{rng.integers(200)}-rc{rng.integers(9)} build {number(4, 9)}"
    if kind == 6:
        text = _prose(rng, 40).encode()
        coded = base64.b64encode(text).decode()
        width = int(rng.integers(60, 77))
        return "\n".join(coded[i:i + width] for i in range(0, len(coded), width))
    if kind == 7:
        return word() + "".join(word().title() for _ in range(int(rng.integers(1, 5)))) + "()"
    if kind == 8:
        return "_".join(word() for _ in range(int(rng.integers(2, 6)))) + f" = {number(1, 5)}"
    if kind == 9:
        return f"order {('ORD', 'INV', 'REF', 'SKU')[int(rng.integers(4))]}-20{number(2, 2)}-{number(4, 9)}"
    if kind == 10:
        return f"+{number(2, 2)} {number(3, 3)} {number(6, 8)}, {number(9, 16)}"
    if kind == 11:
        return f"{word()}.{word()}@{word()}{number(1, 2)}.org"
    if kind == 12:
        return f"192.168.{rng.integers(256)}.{rng.integers(256)}:{number(2, 4)} #{hexa(6)}"
    if kind == 13:
        return f"key: {word()}, {word()}={number(1, 4)}, mode: {word()}{number(1, 2)}"
    if kind == 14:
        return f"ISBN 978-{number(1, 1)}-{number(3, 5)}-{number(3, 5)}-{number(1, 1)}, {word()}{number(1, 3)}, mp3"
    return f"[{word()}]({word()}/{word()}.md) the {word()}-{word()}-{word()} of {word().upper()}_{word().upper()}"


def _windows(texts: list[bytes], spans: list[list[tuple[int, int]]], others: list[list[tuple[int, int]]], reach: int, most: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around so many (``most``) of the given byte spans of each text
    (of secrets, and of others), and one elsewhere, at places drawn by a hash of
    the text."""
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    buf = np.frombuffer(b"".join(texts), np.uint8)
    start, end, row = tokens(buf, off)
    feature, bounds, out = token_features(buf, off, start, end, row), per_row(row, len(texts)), []
    for r, own in enumerate(spans):
        a, b = int(bounds[r]), int(bounds[r + 1])
        if a == b:
            continue
        rng = np.random.default_rng(zlib.crc32(texts[r]))
        tag, centres = np.zeros(b - a, np.int64), []
        for s, e in own:
            hit = np.flatnonzero((start[a:b] < e + off[r]) & (end[a:b] > s + off[r]))
            tag[hit] = 2
            tag[hit[:1]] = 1
            centres.append(int(hit[0]) if len(hit) else 0)
        for s, e in others[r]:
            hit = np.flatnonzero((start[a:b] < e + off[r]) & (end[a:b] > s + off[r]))
            centres.append(int(hit[int(rng.integers(len(hit)))]) if len(hit) else 0)
        chosen = rng.permutation(len(centres))[:most[r]].tolist()
        for c in [*(centres[k] for k in chosen), int(rng.integers(b - a))]:
            lo, hi = max(0, c - reach), min(b - a, c + reach)
            out.append((feature[a + lo:a + hi], tag[lo:hi]))
    return out


def _spans_in_bytes(text: str) -> list[tuple[int, int]]:
    return [(len(text[:s].encode()), len(text[:e].encode())) for s, _, e in base_spans(text)]


def _any_word(found: re.Match, rng: np.random.Generator) -> str:
    word = _letters(rng, 3, 12, _LETTERS[26:52])
    return word if found[0] == "#w" else word.title()


def _with_lines(text: str, rng: np.random.Generator, lines: int = 6) -> tuple[bytes, list[tuple[int, int]], list[tuple[int, int]]]:
    """A copy with made-up lines put between its words, half of them secrets;
    the spans of its secrets, and those of the harmless lines."""
    cuts = np.sort(rng.choice([m.start() for m in re.finditer(" ", text)] or [0], lines))
    parts, spans, harmless, at, size = [], [], [], 0, 0
    for k, cut in enumerate(cuts.tolist()):
        if k % 2:
            line, value = " " + made_harmless(rng), None
        else:
            value = made_secret(rng)
            context = CONTEXTS[int(rng.integers(len(CONTEXTS)))]
            while len(value) < 16 and not set(context) & set("=:\"'<"):      # a short value alone could be anything
                context = CONTEXTS[int(rng.integers(len(CONTEXTS)))]
            context = re.sub("#[wW]", lambda m: _any_word(m, rng), context)
            before, after = context.split("{}")
            line = f" {before}{value}{after}"
        raw = text[at:cut].encode()
        parts.append(raw)
        size += len(raw)
        if value is not None:
            spans.append((size + 1 + len(before), size + 1 + len(before) + len(value)))
        else:
            harmless.append((size + 1, size + len(line)))
        parts.append(line.encode())
        size, at = size + len(line), cut
    parts.append(text[at:].encode())
    whole = b"".join(parts)
    return whole, sorted({*spans, *_spans_in_bytes(whole.decode())}), harmless


def _labelled_windows(buf: np.ndarray, off: np.ndarray, reach: int, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of the texts, of copies in which each base span has random
    letters and digits instead, and of copies with made-up lines."""
    raw = buf.tobytes()
    texts, spans, others = [], [], []
    for r in range(len(off) - 1):
        text = raw[off[r]:off[r + 1]].decode("utf-8", "replace")
        own, rng = text.encode(), np.random.default_rng(zlib.crc32(raw[off[r]:off[r + 1]]))
        found = _spans_in_bytes(text)
        texts.append(own)
        spans.append(found)
        if found:
            other = bytearray(own)
            for s, e in found:
                other[s:e] = _letters(rng, e - s, e - s).encode()
            texts.append(bytes(other))
            spans.append(found)
        more, added, harmless = _with_lines(text, rng)
        texts.append(more)
        spans.append(added)
        others += [[]] * (len(texts) - len(others) - 1) + [harmless]
    # of texts as they are and with other letters a third: their contexts are few
    return _windows(texts, spans, others, reach, [most if o else max(1, most // 3) for o in others])


def fit_field(documents: DataFrame, *, text: str = "text", sample_rows: int = 500, reach: int = 12, windows: int = 6) -> Field | None:
    """The field from at most ``sample_rows`` distinct texts with a base span
    and as many without, chosen by a hash of the text, with at most
    ``windows`` windows in a copy with made-up lines and a third of it in the
    others.  None without a base span."""
    shaped = documents.select(F.col(text).alias("__text"), F.xxhash64(text).alias("__h")).where("__text is not null")
    flagged = F.lit(False)
    for pattern, group, least in BASE:
        values = F.regexp_extract_all("__text", F.lit(("(?i)" if pattern.flags & re.IGNORECASE else "") + pattern.pattern), F.lit(group))
        flagged |= F.array_max(F.transform(values, F.length)) >= least
    # distinct hashes first: copies of a text leave room for others, and no text is shuffled
    scratch = Scratch(documents.sparkSession, "secret-scan")
    seen = scratch.save(shaped.select("__h", F.coalesce(flagged, F.lit(False)).alias("__flag")).distinct(), "flags")
    pick = lambda flag: seen.where(F.col("__flag") == flag).orderBy("__h").limit(sample_rows).select("__h")
    chosen = scratch.save(pick(True).unionByName(pick(False)), "sample")
    sample = shaped.join(sized(chosen, 2 * sample_rows), "__h").groupBy("__h").agg(F.min("__text").alias("__text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, buf, off in blocks(batches, "__text"):
            found = _labelled_windows(buf, off, reach, windows)
            yield pa.RecordBatch.from_pydict({"f": pa.array([f.astype(np.int32).tobytes() for f, _ in found], pa.binary()), "t": pa.array([t.astype(np.int8).tobytes() for _, t in found], pa.binary()),
                                              "base": pa.array([len(base_spans(x)) > 0 for x in (buf.tobytes().decode("utf-8", "replace"),)] * len(found), pa.bool_())})

    rows = [(bytes(r.f), bytes(r.t), r.base) for r in sample.mapInArrow(cut, "f binary, t binary, base boolean").toLocalIterator()]
    if not any(r[2] for r in rows):
        return None
    got = sorted({r[:2] for r in rows})
    return fit([(np.frombuffer(f, np.int32).reshape(-1, FAMILIES).astype(np.int64), np.frombuffer(t, np.int8).astype(np.int64)) for f, t in got])


def find_spans(buf: np.ndarray, off: np.ndarray, field: Field | None) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in code points of each row's spans, by start, then kind."""
    raw = buf.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    out = [base_spans(t) for t in texts]
    if field is None:
        return out
    start, end, row = tokens(buf, off)
    tag = field.decode(field.emissions(token_features(buf, off, start, end, row)), row)
    hit = np.flatnonzero(tag)
    if not len(hit):
        return out
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])       # code points before each byte
    new = np.concatenate([[True], (np.diff(hit) != 1) | (row[hit[1:]] != row[hit[:-1]]) | (tag[hit[1:]] == 1)])
    begin = np.flatnonzero(new)
    close = np.append(begin[1:], len(hit)) - 1
    for b, c in zip(begin.tolist(), close.tolist()):
        r = int(row[hit[b]])
        s, e = int(lead[start[hit[b]]] - lead[off[r]]), int(lead[end[hit[c]]] - lead[off[r]])
        if e - s >= LEAST_CRF and not any(x < e and y > s for x, k, y in out[r] if k < 3):
            out[r].append((s, 3, e))
    return [sorted(x) for x in out]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(documents: DataFrame, field: Field | None, *, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, counts per base kind, the digest of the base spans,
    and all spans."""
    fields = documents.select(keep).schema
    shared = documents.sparkSession.sparkContext.broadcast(field)
    names = [*keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, "__text", BLOCK):
            found = find_spans(buf, off, shared.value)
            base = [[x for x in f if x[1] < 3] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], *(pa.array([sum(x[1] == k for x in b) for b in base], pa.int64()) for k in range(3)),
                 pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string()), pa.array([written(f) for f in found], pa.string())], names=names)

    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"])
    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(run, out_type)


def redact(documents: DataFrame, field: Field | None, *, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """All columns, each span of the text replaced by ``mark`` (overlapping
    spans once).  ``length`` names a column of code point counts to renew.
    A null text stays null."""
    names = documents.columns
    shared = documents.sparkSession.sparkContext.broadcast(field)
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, off in blocks(batches, text, BLOCK):
            texts = rows.column(at).to_pylist()
            for i, spans in enumerate(find_spans(buf, off, shared.value)):
                parts, done = [], 0
                for s, _, e in spans:
                    if e > done:
                        parts += [texts[i][done:s], mark] if s >= done else []
                        done = e
                if spans:
                    texts[i] = "".join([*parts, texts[i][done:]])
            columns = list(rows.columns)
            columns[at] = pa.array(texts, rows.schema.field(at).type)
            if length:
                k = names.index(length)
                columns[k] = pa.array([None if t is None else len(t) for t in texts], rows.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return documents.mapInArrow(run, documents.schema)
