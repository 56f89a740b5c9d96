"""Near-duplicates, decontamination, long repeats, licences and the pipeline,
against brute force on small tables."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pytest
from llm_data import SCHEMA, documents, empty, prose
from pyspark.sql import functions as F

from tabprep.llm import components, decontaminate, license_scan, near_dup, suffix_dedup
from tabprep.llm.shared import Scratch

SF = "/root/testdata/sf0.001"


def shingles(text):
    t = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(rows):
    """Component of each row's set, by comparing all pairs of distinct sets."""
    sets = sorted({shingles(t) for _, t in rows} - {frozenset()}, key=str)
    to = {s: s for s in sets}

    def find(s):
        while to[s] != s:
            s = to[s]
        return s

    for k, a in enumerate(sets):
        for b in sets[:k]:
            if 100 * len(a & b) >= 75 * len(a | b) and find(a) != find(b):
                to[find(a)] = find(b)
    least = {}
    for i, t in rows:
        s = shingles(t)
        if s and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    return [(i, len(shingles(t)), least.get(find(shingles(t))) if shingles(t) else i) for i, t in rows]


def near_copies(seed=4, groups=6):
    """Chains of copies, so that members of a group may link only through others."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        own = [f"w{g}x{rng.randrange(10**6)}" for _ in range(rng.randint(12, 90))]
        for _ in range(rng.randint(2, 9)):
            own = list(own)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = f"z{rng.randrange(10**6)}"
            out.append(" ".join(own))
    common = " ".join(f"c{k}" for k in range(30))
    out += [common + " " + " ".join(f"u{k}y{j}" for j in range(rng.randint(3, 40))) for k in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", block)
    df = documents(spark)
    df = df.unionByName(documents(spark, [(500 + k, t) for k, t in enumerate(near_copies())]))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.find_groups(df).collect()), key=str)
    assert got == sorted(linked(rows), key=str)


def test_keep_one_of_each_group(spark):
    df = documents(spark).unionByName(documents(spark, [(500 + k, t) for k, t in enumerate(near_copies(5, 3))]))
    out = near_dup.keep_one(df)
    assert out.columns == df.columns
    rows, kept = [(r.doc_id, r.text) for r in df.collect()], [(r.doc_id, r.text) for r in out.collect()]
    own = collections.defaultdict(set)
    for (i, t), (_, n, c) in zip(rows, linked(rows)):
        if n:
            own[c].add((i, t))
    inside = collections.Counter(c for (i, t), (_, n, c) in zip(rows, linked(rows)) if n and kept.count((i, t)))
    assert set(inside) == set(own) and all(sum(kept.count(x) for x in own[c]) == 1 for c in own)
    assert {x for x in rows if not shingles(x[1])} <= set(kept)


def test_near_duplicates_of_nothing(spark):
    assert near_dup.find_groups(empty(spark)).collect() == []
    assert near_dup.keep_one(empty(spark)).collect() == []


def test_keys_find_every_pair_within_the_radius(spark):
    """Pigeonhole: signatures with RADIUS differing symbols share a key, wherever they differ."""
    rng = np.random.default_rng(3)
    sigs = []
    for k in range(40):
        a = rng.integers(0, 1 << 16, near_dup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[rng.choice(near_dup.SYMBOLS, near_dup.RADIUS, replace=False)] ^= 1
        sigs += [(2 * k, bytearray(a.tobytes())), (2 * k + 1, bytearray(b.tobytes()))]
    keys = near_dup.index_keys(spark.createDataFrame(sigs, "rep bigint, sig binary")).collect()
    own = collections.defaultdict(set)
    for r in keys:
        own[r.rep].add(r.key)
    assert all(own[2 * k] & own[2 * k + 1] for k in range(40))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)], "a bigint, b bigint")
    got = {r.v: r.c for r in components.components(links, Scratch(spark, "test")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 90, 90: 90, 95: 90}


# --- decontamination -------------------------------------------------------

def symbols(text):
    raw = (text or "").encode()
    return decontaminate.word_symbols(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64))[0][:-1].tolist()


def substring_distance(item, text):
    prev = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        cur = [i]
        for j, x in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (w != x)))
        prev = cur
    return min(prev)


def test_edit_distance_inside():
    rng = random.Random(1)
    for _ in range(300):
        a, b = [rng.randint(1, 5) for _ in range(rng.randint(1, 12))], [rng.randint(1, 5) for _ in range(rng.randint(0, 20))]
        assert decontaminate.edit_distance_inside(np.array(a), np.array(b, np.int64)) == substring_distance(a, b)


def test_merged_walks_equal_single_walks():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 12, 300).astype(np.uint64)
    text[[100, 299]] = 0
    for repeat in (0, 3):
        for c, first, key in decontaminate.walk_keys(text, repeat, [0, 2]):
            group = np.searchsorted(first, np.arange(300), "right") - 1
            for s in range(0, 300, 7):
                alone = next(decontaminate.walk_keys(text, repeat, [c], np.array([s])))[2][0]
                assert alone == key[group[s]]


def planted(seed=3):
    rng = random.Random(seed)
    items = [" ".join(f"q{rng.randrange(400)}" for _ in range(n)) for n in (5, 8, 15, 30, 60, 150, 30)]
    items[6] = items[3]
    rows, want = [], []
    for k in range(120):
        text = prose(rng, 150).split(" ")
        if k % 3 == 0:
            i = k // 3 % len(items)
            words = items[i].split(" ")
            if k % 2:
                words = [w.upper() + "," for w in words]
            for _ in range(len(words) // 12 if k % 4 == 0 else 0):
                words[rng.randrange(len(words))] = "other"
            at = rng.randrange(len(text))
            text[at:at] = words
        rows.append((k, " ".join(text)))
    for k, t in rows:
        for i, item in enumerate(items):
            a = symbols(item)
            if substring_distance(a, symbols(t)) <= (int(0.2 * len(a)) if len(a) >= 8 else 0):
                want.append((k, i))
    return items, rows, want


def test_planted_items_are_found(spark):
    items, rows, want = planted()
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "the")], "item_id bigint, text string")
    df = documents(spark, [*rows, (0, "other text of the same id"), (None, items[4]), (700, None), (701, "")])
    got = {(r.doc_id, i) for r in decontaminate.mark_documents(df, bench).collect() for i in r["items"]}
    assert got == {*want, (None, 4)}
    clean = decontaminate.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    hit = {k for k, _ in want} | {None}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in df.collect() if r.doc_id not in hit)


def test_recall_on_edited_items():
    """The repeats set on one sample of edited items find new ones as often."""
    rng = np.random.default_rng(5)
    draw = lambda: [rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (20, 30, 45, 60) for _ in range(10)]
    repeats = decontaminate.repeats_for(draw(), 0.1, 0.97)
    found = [decontaminate.found_by(own, decontaminate.edited(own, len(own) // 10, rng), len(own) // 10, repeats).any() for own in draw() for _ in range(3)]
    assert np.mean(found) >= 0.9


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    df = documents(spark, [(1, "some words"), (2, None)])
    assert {(r.doc_id, r.contaminated, r.n_items) for r in decontaminate.mark_documents(df, none).collect()} == {(1, False, 0), (2, False, 0)}
    assert decontaminate.mark_documents(empty(spark), none).collect() == []
    assert decontaminate.drop_contaminated(df, none).count() == 2


# --- long repeats ----------------------------------------------------------

def without_repeats(rows, length):
    seen = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed=6):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (70, 90, 130)]
    out = []
    for k in range(40):
        parts = [prose(rng, rng.randint(5, 80))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(shared)
            cut = rng.randint(0, len(p) // 4)
            parts += [p[cut:], prose(rng, rng.randint(1, 40))]
        out.append(" ".join(parts))
    return out


@pytest.mark.parametrize("crowded,batches", [(4096, 4), (1, 5), (2, 1)])
def test_long_repeats_equal_brute_force(spark, crowded, batches):
    df = documents(spark).unionByName(documents(spark, [(900 + k, t) for k, t in enumerate(passages())]))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(df, crowded=crowded, batches=batches).collect()), key=str)
    assert got == without_repeats(rows, 400)


def test_long_repeats_in_pieces_of_one_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700)
    from tabprep.llm import kernels
    monkeypatch.setattr(kernels, "BLOCK_BYTES", 700)
    rng = random.Random(8)
    part = prose(rng, 120)
    rows = [(1, prose(rng, 300) + part + prose(rng, 200) + part), (2, prose(rng, 500))]
    hashes = [suffix_dedup.anchor_runs(*args, 400) for args in [(np.frombuffer(rows[0][1].encode(), np.uint8), np.array([0, len(rows[0][1].encode())]))]]
    assert hashes[0] is not None
    buf = np.frombuffer(rows[0][1].encode(), np.uint8)
    whole = {(int(x), int(p)) for _, r, a, lo, hi in hashes for x, l, h in zip(a, lo, hi) for p in range(l, h + 1)}
    cut = set()
    for at, piece, off in suffix_dedup._segments(buf, np.array([0, len(buf)]), 400):
        _, _, a, lo, hi = suffix_dedup.anchor_runs(piece, off, 400)
        cut |= {(int(x) + at, int(p) + at) for x, l, h in zip(a, lo, hi) for p in range(l, h + 1)}
    assert cut == whole


def test_index_levels_merge_geometrically(spark):
    index, hits = suffix_dedup.SuffixIndex(spark, Scratch(spark, "test")), []
    sizes = []
    for b in range(5):
        keys = spark.createDataFrame([(b,), (100 + b,), (7777,)], "core bigint")
        hits.append({r.core for r in index.add(keys).collect()})
        sizes.append(sorted(index.levels))
    assert hits == [set(), {7777}, {7777}, {7777}, {7777}]
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
    assert index.levels[2].where("core = 7777").first().n == 4
    index.close()


def test_long_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(empty(spark), length=100)


# --- licences --------------------------------------------------------------

def test_licences_inherit_from_the_nearest_directory(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/x.txt", "plain words"), ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
            ("a/b/c/d.txt", "plain"), ("a/b/e.txt", "many other words of prose here\nLicensed under CC BY-NC 4.0.\n" + "more words " * 40), ("z/f.txt", None), ("top.txt", ""), (None, "plain")]
    df = documents(spark, [(k, t) for k, (_, t) in enumerate(rows)])
    paths = F.element_at(F.array(*(F.lit(p) for p, _ in rows)), (F.col("doc_id") + 1).cast("int"))
    got = {r.doc_id: r for r in license_scan.scan_licenses(df, paths).collect()}
    assert [got[k].license for k in range(8)] == ["MIT", "MIT", "GPL-3.0", "GPL-3.0", "CC-BY-NC-4.0", None, None, None]
    assert [got[k].inherited_from for k in (1, 3)] == ["a", "a/b"]
    assert got[4].own_line == 1 and got[4].own_score == 1.0 and got[4].declared is None


def test_licences_of_awkward_rows(spark):
    df = documents(spark)
    out = license_scan.scan_licenses(df, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    assert out.count() == df.count()
    assert license_scan.scan_licenses(empty(spark), F.col("source")).collect() == []


def test_licences_run_no_python(spark):
    plan = license_scan.scan_licenses(documents(spark, [(1, "Released under the MIT License.")]), F.col("source"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- pipeline and registration ---------------------------------------------

def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    from tabprep.sources.tables import read_table
    docs = read_table(spark, SF, "documents")
    names, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert k == 4 or out.columns == names
        docs = Scratch(spark, "test").save(out, "stage")
        assert 0 < docs.count() <= before
        before = docs.count()
    rows = {tuple(r) for r in docs.select("doc_id", "n_tokens", "decoded").collect()}
    assert rows == {tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "decoded").collect()}


def test_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    import corpus_pipeline
    for t in ("labels", "benchmark"):
        os.symlink(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    for start in (documents(spark), empty(spark)):
        docs = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = Scratch(spark, "test").save(stage(spark, docs, str(tmp_path)), "stage")
            assert k == 4 or docs.columns == [f.name for f in SCHEMA]


def test_every_operator_is_registered():
    import __spark_entry__
    found = __spark_entry__.queries()
    assert all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 11)) and "pipeline" in found


def test_licence_oracle(spark):
    from tabprep.plans.oracle_check import compare
    assert "ok" in compare(spark, SF, ["op9_license_scan"])["op9_license_scan"]
