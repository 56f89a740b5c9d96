"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import documents, empty, texts

from tabprep.llm import spelling
from tabprep.llm.shared import Scratch

LOWER = {i: i + 32 for i in range(65, 91)}


def counted(rows, divisor=199, min_chars=6, min_count=5):
    out = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % divisor == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= min_chars and n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def expected(words, factor=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def edited(rng, w, letters):
    k = rng.randrange(len(w) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return w[:k] + rng.choice(letters) + w[k:]
    k = min(k, len(w) - 1)
    return w[:k] + w[k + 1:] if kind == 1 else w[:k] + rng.choice(letters) + w[k + 1:]


def families(seed, letters="abcdeéÿ", n=60, sizes=(6, 14)):
    rng, words = random.Random(seed), {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*sizes)))
        words[w] = 10 ** rng.randint(1, 5)
        for _ in range(6):
            w = edited(rng, w, letters)
            if len(w) >= sizes[0]:
                words.setdefault(w, max(5, words.get(w, 0) or rng.randint(5, 400)))
    return words


def run(spark, words, **more):
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    return sorted((tuple(r) for r in spelling.variant_forms(df, **more).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("crowd", [0, 3, 512])
def test_forms_equal_all_pairs(spark, crowd):
    # two letters: repeated bigrams, ties in the order, crowded keys
    words = {**families(1), **families(2, "ab", 30, (6, 9)), "aaaaaa": 9, "aaaaaaa": 60, "aaaaaaaa": 700, "x" * 400: 5, "x" * 401: 25}
    assert run(spark, words, crowd=crowd) == expected(words)


def test_chains_of_forms_and_ties(spark):
    words = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "abcdex": 25, "zzzzzz": 7, "zzzzzy": 34}
    got = {r[0]: r for r in run(spark, words)}
    assert got["abcdef"][1:3] == ("abcdefg", "abcdefghi") and got["zzzzzz"][1] is None
    assert run(spark, words) == expected(words)


def test_counts_of_whole_texts(spark, monkeypatch):
    own = [*texts(3), "Straße Überall überall ÜBERALL über×all÷", "naïveté " * 40, ("longer words here " * 5000) + "tail", "abcdefgh日abcdefgh"]
    rows = [(i, t) for i, t in enumerate(own)] + [(0, own[0]), (None, own[5]), (None, None)]
    df = documents(spark, rows)
    for divisor, least in ((199, 5), (2, 1)):
        got = {r.word: r.n for r in spelling.count_words(df, divisor=divisor, min_count=least).collect()}
        assert got == counted(rows, divisor, 6, least)
    whole, cut = {}, {}
    for i, t in rows:
        spelling._add_words(whole, str(i), (t or "").encode(), 3, 6)
    monkeypatch.setattr(spelling, "PIECE_BYTES", 7)
    for i, t in rows:
        spelling._add_words(cut, str(i), (t or "").encode(), 3, 6)
    assert whole == cut


def test_query_on_documents(spark):
    from tabprep.llm.queries import op12_spelling_variants
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op12_spelling_variants(spark, "/root/testdata/sf0.001").select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    assert got == expected(counted(rows)) and len(got) > 100
    assert spelling.spelling_variants(empty(spark)).collect() == []


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(4)
    codes = rng.integers(97, 101, (200, 9)).astype(np.uint64)
    counts = rng.integers(1, 50, spelling.CLASSES)
    rank = np.empty(spelling.CLASSES, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(spelling.CLASSES, dtype=np.uint64)
    prefix, last, pivots = spelling.prefix_and_pivots(codes, counts, rank)
    cost = counts[spelling._class(spelling._grams(codes))]
    for k in range(len(codes)):
        pairs = [(i, j) for i in range(8) for j in range(i + 2, 8) if prefix[k, i] and prefix[k, j]]
        assert prefix[k].sum() >= 3 and tuple(pivots[k]) in pairs
        assert cost[k][pivots[k]].sum() == min(cost[k, i] + cost[k, j] for i, j in pairs)


def test_rows_grow_with_the_words_of_a_crowded_key(spark):
    """One word beginning shared by many words: the index of its key grows four
    times at most, and the join emits near words alone."""
    rng = random.Random(8)
    words = {"qz" + "".join(rng.choice("abcdefgh") for _ in range(8)): rng.randint(5, 99) for _ in range(3000)}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    scratch = Scratch(spark, "spelling-test")
    index = scratch.save(spelling.gram_index(df, spelling.gram_counts(df)), "grams")
    assert spelling._halves(index).count() <= 4 * index.count()
    pairs = spelling.near_words(scratch.save(df, "words"), scratch, crowd=50)
    assert {(r.a, r.b) if r.a < r.b else (r.b, r.a) for r in pairs.collect()} == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
