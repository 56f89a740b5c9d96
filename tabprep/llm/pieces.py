"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The normalised text (dummy space in front, spaces as U+2581) is cut where a
run of spaces begins; no piece of the vocabulary spans such a cut, so the
parts ("words") are independent.  New words of a block are laid out as one
flat array of symbols.  In each round every word takes its pair of smallest
merge rank, all words at once, and the leftmost pairs of that rank merge;
the array is compacted, and words without a mergeable pair leave.  Several
pairs of one word merge in the same round only where that equals merging
them one by one: if a merge would open a pair of equal or smaller rank, that
word merges its leftmost pair alone.  Symbols that are no pieces fall back to
byte pieces.  Each worker keeps the ids of words it has met.

Results: a null text counts as empty (no ids, empty text); an empty table
gives an empty result; repeated rows give repeated results; columns other
than those named are ignored by ``encode_decode``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import blocks, kept, strings

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NO_RANK = np.int32(2**31 - 1)


class PieceModel:
    """Vocabulary of a BPE model with byte fallback, as numpy tables."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.byte_id = np.full(256, -1, np.int64)
        self.plain: dict[str, int] = {}
        self.unknown = model.unk_id()
        special = set()
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
            elif model.is_control(i) or model.is_unknown(i):
                special.add(i)
            elif not model.is_unused(i):
                self.plain[name] = i
        crossing = [p for p in self.plain if SPACE in p.lstrip(SPACE)]
        if crossing or (self.byte_id < 0).any():
            raise ValueError("the model must have byte pieces, and no piece with a space inside")
        # symbols: pieces, then single characters that occur in pieces without being one
        self.symbol = dict(self.plain)
        for c in sorted({c for p in self.plain for c in p}.difference(self.plain)):
            self.symbol[c] = size + len(self.symbol)
        score = {p: model.get_score(i) for p, i in self.plain.items()}
        ordered = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = []
        for p, i in self.plain.items():
            for k in range(1, len(p)):
                a, b = self.symbol.get(p[:k]), self.symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs.append(((a << 32) | b, ordered[score[p]], i))
        self._hash_pairs(pairs)
        # decoding: the bytes of each piece
        raw = []
        for i, name in enumerate(names):
            raw.append(bytes([int(name[3:5], 16)]) if model.is_byte(i) else b" \xe2\x81\x87 " if i == self.unknown else b"" if i in special else name.replace(SPACE, " ").encode())
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.piece_off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        self.piece_raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw = raw
        self.code = np.full(0x110000, -1, np.int32)
        for s, i in self.symbol.items():
            if len(s) == 1:
                self.code[ord(s)] = i

    def _hash_pairs(self, pairs: list[tuple[int, int, int]]) -> None:
        """Open addressing with linear probing, four times as many slots as pairs."""
        self.bits = max(10, int(len(pairs) * 4).bit_length())
        key = np.full(1 << self.bits, -1, np.int64)
        rank, made = np.full(1 << self.bits, NO_RANK, np.int32), np.zeros(1 << self.bits, np.int32)
        slot = self._slot(np.array([p[0] for p in pairs], np.int64))
        self.probes = 1
        for (k, r, i), s in zip(pairs, slot.tolist()):
            n = 1
            while key[s] >= 0:
                s, n = (s + 1) & ((1 << self.bits) - 1), n + 1
            key[s], rank[s], made[s] = k, r, i
            self.probes = max(self.probes, n)
        self.key, self.rank, self.made = key, rank, made

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_RANK where there is none."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        wanted = np.where((a < 0) | (b < 0), np.int64(-2), (a << 32) | b)
        slot = self._slot(wanted)
        rank, made = np.full(len(a), NO_RANK, np.int32), np.zeros(len(a), np.int32)
        open_ = np.arange(len(a))
        for _ in range(self.probes):
            at = self.key[slot[open_]]
            hit = at == wanted[open_]
            rank[open_[hit]] = self.rank[slot[open_[hit]]]
            made[open_[hit]] = self.made[slot[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return rank, made

    def _rank(self, at: np.ndarray, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
        """Set rank and merged symbol of the pairs that start at these places."""
        rank[at] = NO_RANK
        at = at[at + 1 < len(sym)]
        at = at[word[at] == word[at + 1]]
        rank[at], made[at] = self.pair(sym[at], sym[at + 1])

    def _one_by_one(self, at: np.ndarray, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Of the places with their word's least rank, those that may merge in
        one round with the same outcome as merging one after another."""
        next_same = np.zeros(len(at) + 1, bool)
        next_same[1:-1] = word[at[1:]] == word[at[:-1]]
        several = next_same[1:] | next_same[:-1]             # in a word with more than one
        if not several.any():
            return at
        many, single = at[several], at[~several]
        # neighbouring hits overlap: every second one of such a run merges
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(many) != 1) | (word[many[1:]] != word[many[:-1]])]))
        place = np.arange(len(many)) - np.repeat(begin, np.diff(np.append(begin, len(many))))
        many = many[place % 2 == 0]
        # the pairs that each merge opens, with what is further left merged already
        before = np.zeros(len(many), np.int32) - 1
        ok = many > 0
        ok[ok] = word[many[ok] - 1] == word[many[ok]]
        before[ok] = sym[many[ok] - 1]
        touching = np.flatnonzero(np.concatenate([[False], (np.diff(many) == 2) & (word[many[1:]] == word[many[:-1]])]))
        before[touching] = made[many[touching - 1]]
        opened = np.where(ok, self.pair(before, made[many])[0], NO_RANK)
        ok = many + 2 < len(sym)
        ok[ok] = word[many[ok] + 2] == word[many[ok]]
        opened[ok] = np.minimum(opened[ok], self.pair(made[many[ok]], sym[many[ok] + 2])[0])
        unsafe = np.unique(word[many[opened <= rank[many]]])
        if len(unsafe):
            lead = np.concatenate([[True], word[many[1:]] != word[many[:-1]]])
            many = many[lead | ~np.isin(word[many], unsafe)]
        return np.sort(np.concatenate([single, many]))

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int32)
        sym = self.code[points]
        sym = np.where(sym >= 0, sym, -1 - points)           # unknown characters keep their code point
        word = np.repeat(np.arange(len(words), dtype=np.int32), list(map(len, words)))
        rank = np.full(len(sym), NO_RANK, np.int32)          # of the pair that starts at each symbol
        made = np.zeros(len(sym), np.int32)
        self._rank(np.arange(len(sym)), sym, word, rank, made)
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            best = np.repeat(least, length)
            keep = best < NO_RANK
            if not keep.all():                               # finished words leave
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
            at = np.flatnonzero(keep & (rank == best))
            if not len(at):
                break
            at = self._one_by_one(at, sym, word, rank, made)
            sym[at] = made[at]
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1                     # where the merged symbols will be
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            self._rank(at, sym, word, rank, made)
            self._rank(at[at > 0] - 1, sym, word, rank, made)
        if not done_sym:
            return [np.zeros(0, np.int32) for _ in words]
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        odd = (sym < 0) | (sym >= len(self.is_byte))
        if odd.any():                                        # characters that are no pieces become their bytes
            name = {v: k for k, v in self.symbol.items() if v >= len(self.is_byte)}
            parts, owner, at = [], [], 0
            for i in np.flatnonzero(odd).tolist():
                c = chr(-1 - sym[i]) if sym[i] < 0 else name[sym[i]]
                b = self.byte_id[np.frombuffer(c.encode(), np.uint8)]
                parts += [sym[at:i], b]
                owner += [word[at:i], np.full(len(b), word[i])]
                at = i + 1
            sym, word = np.concatenate([*parts, sym[at:]]), np.concatenate([*owner, word[at:]])
        cut = np.searchsorted(word, np.arange(len(words) + 1))
        return [sym[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids: pieces side by side, U+2581 as a space,
        the dummy space at the front dropped.  Runs of byte pieces are read as
        UTF-8, each invalid byte as U+FFFD."""
        if not len(ids):
            return ""
        start, length = self.piece_off[ids], self.piece_off[ids + 1] - self.piece_off[ids]
        total = np.concatenate([[0], np.cumsum(length)])
        raw = self.piece_raw[np.arange(total[-1]) + np.repeat(start - total[:-1], length)].tobytes()
        if self.is_byte[ids].any():
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = self._decode_runs(ids)
        else:
            text = raw.decode()
        return text[1:] if text[:1] == " " and not self.is_byte[ids[0]] and ids[0] != self.unknown else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        out, run = [], bytearray()
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.raw[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:n]).decode())
                        del run[:n]
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    del run[:1]
            if i >= 0:
                out.append(self.raw[i].decode())
        return "".join(out)


class Encoder:
    """Ids of whole texts.  Words met before are kept: a number per word, and
    the ids of all words side by side in one array.  250,000 words take some
    60 MB; when there are more, those of the current block stay."""

    def __init__(self, path: str, cache_size: int = 250_000):
        self.model, self.cache_size = PieceModel(path), cache_size
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.cut = np.zeros(1 << 16, np.int64)
        self.used = 0                                        # words; their ids end at cut[used]

    def _add(self, names: list[str], ids: list[np.ndarray]) -> None:
        end = self.cut[self.used] + np.cumsum([len(i) for i in ids])
        while end[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.used + len(names) >= len(self.cut):
            self.cut = np.concatenate([self.cut, np.zeros_like(self.cut)])
        self.ids[self.cut[self.used]:end[-1]] = np.concatenate(ids)
        self.cut[self.used + 1:self.used + 1 + len(names)] = end
        self.known.update(zip(names, range(self.used, self.used + len(names))))
        self.used += len(names)

    def _learn(self, wanted: set[str]) -> None:
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > self.cache_size:     # keep the words of this block only
            stay = [w for w in wanted if w in self.known]
            ids = [self.ids[self.cut[i]:self.cut[i + 1]].copy() for i in map(self.known.__getitem__, stay)]
            self.known, self.used = {}, 0
            if stay:
                self._add(stay, ids)
        for k in range(0, len(new), 16_384):
            part = new[k:k + 16_384]
            self._add(part, self.model.merge(part))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [_WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self._learn(set().union(*parts))
        get, out = self.known.__getitem__, []
        for p in parts:
            at = np.fromiter(map(get, p), np.int64, len(p))
            start, length = self.cut[at], self.cut[at + 1] - self.cut[at]
            total = np.cumsum(length)
            n = int(total[-1]) if len(total) else 0
            out.append(self.ids[np.arange(n) + np.repeat(start - total + length, length)])
        return out


def encoder(path: str) -> Encoder:
    return kept("pieces", path, lambda: Encoder(path))


def encode_decode(documents: DataFrame, model_path: str, *, text: str = "text", keep: list[str] | None = None, digests: bool = False) -> DataFrame:
    """The kept columns of every row, then ``n_tokens`` and either
    ``token_ids`` and ``decoded`` or, with ``digests``, their SHA-256."""
    keep = ["doc_id"] if keep is None else keep
    fields = documents.select(keep).schema
    made = [("ids_sha256", "string"), ("decoded_sha256", "string")] if digests else [("token_ids", "array<int>"), ("decoded", "string")]
    taken = {c.lower() for c in ("n_tokens", *(c for c, _ in made))}
    if taken & {c.lower() for c in keep}:
        raise ValueError(f"a kept column has the name of a result column: {sorted(taken)}")
    out_type = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_tokens bigint", *(f"{c} {t}" for c, t in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path)
        for rows, buf, off in blocks(batches, "__text", owner="pieces"):
            ids = own.encode(strings(buf, off))
            back = [own.model.decode(i) for i in ids]
            n = pa.array([len(i) for i in ids], pa.int64())
            if digests:
                out = [pa.array([hashlib.sha256(",".join(map(str, i.tolist())).encode()).hexdigest() for i in ids], pa.string()),
                       pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string())]
            else:
                cut = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                flat_ids = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                out = [pa.ListArray.from_arrays(pa.array(cut), pa.array(flat_ids)), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*rows.columns[:len(keep)], n, *out], names=[*keep, "n_tokens", *(c for c, _ in made)])

    return documents.select(*keep, documents[text].alias("__text")).mapInArrow(run, out_type)
