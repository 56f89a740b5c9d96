"""Recall of the decontamination at the full share of edits, per size class."""

import random

import numpy as np
import pytest
from llm_data import documents, prose
from test_pairs_and_pipeline import substring_distance, symbols

from tabprep.llm import decontaminate


def copies(share=0.2, per_size=24, seed=11):
    """Items of every size class, and documents that hold a copy of one with
    that share of its words edited."""
    rng, items, rows = random.Random(seed), [], []
    for n in (8, 10, 13, 20, 30, 45, 70, 110):
        for _ in range(per_size):
            own = [f"q{rng.randrange(4000)}" for _ in range(n)]
            items.append(" ".join(own))
            for _ in range(max(share > 0, int(share * n))):
                kind, at = rng.randrange(3), rng.randrange(len(own))
                own[at:at + (kind != 1)] = [] if kind == 2 else [f"z{rng.randrange(10**6)}"]
            rows.append(" ".join([prose(rng, 20), *own, prose(rng, 20)]))
    return items, rows


@pytest.mark.parametrize("share", [0, 0.1, 0.2])
def test_recall_up_to_the_full_share_of_edits(spark, share):
    items, rows = copies(share)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    found = decontaminate.find_matches(documents(spark, list(enumerate(rows))), bench)
    got = {(r.id, r.item): r.distance for r in found.collect()}
    hits, all_ = {}, {}
    for k, (item, text) in enumerate(zip(items, rows)):
        a = symbols(item)
        d = substring_distance(a, symbols(text))
        if d <= int(0.2 * len(a)):
            c = decontaminate.size_class(len(a))
            all_[c] = all_.get(c, 0) + 1
            hits[c] = hits.get(c, 0) + ((k, k) in got)
            assert got.get((k, k), d) == d
    assert sorted(all_) == list(range(len(decontaminate.SIZES))) and all(n >= 20 for n in all_.values())
    assert all(hits[c] >= (0.95 * all_[c] - 0.5 if share else all_[c]) for c in all_), (hits, all_)


def test_each_class_has_its_own_repeats():
    rng = np.random.default_rng(5)
    draw = lambda n: [rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(20)]
    repeats = decontaminate.repeats_by_class(draw(8) + draw(95), 0.2, 0.99)
    assert set(repeats) == {0, 6} and 2 <= repeats[0] < repeats[6]
    with pytest.raises(ValueError, match="90 words"):
        decontaminate.repeats_by_class(draw(95), 0.2, 0.99, most=4)


def test_short_items_are_found_verbatim(spark):
    rng = random.Random(4)
    items = ["alpha beta gamma", "one two three four", "a b c d e", "u v w x y z", "k l m n o p q", "of the", "word", ""]
    rows = []
    for k in range(200):
        text = prose(rng, 60).split(" ")
        if k % 2:
            own = items[k // 2 % len(items)].upper().replace(" ", ", ").split(" ")
            if k % 5 == 0 and len(own) > 2:
                own[1] = "other"
            at = rng.choice([0, rng.randrange(len(text)), len(text)])
            text[at:at] = own
        rows.append((k, " ".join(text)))
    rows += [(900, "alpha beta"), (901, "gamma"), (902, "beta gamma alpha"), (903, "alpha beta gamma")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.id, r.item): r.distance for r in decontaminate.find_matches(documents(spark, rows), bench).collect()}
    want = {(k, i): 0 for k, t in rows for i, item in enumerate(items) if len(symbols(item)) >= 3 and not substring_distance(symbols(item), symbols(t))}
    assert got == want and {i for _, i in want} == {0, 1, 2, 3, 4}


def test_nothing_of_a_match_is_left_out():
    """Wherever a copy with as many edits as a match may have stands, all of its
    words are among those that are walked."""
    rng = np.random.default_rng(9)
    word = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for n in [*range(8, 30), 45, 70, 110]:
        item, e = word(n), int(0.2 * n)
        assert decontaminate.shared_windows(n, e) >= 2
        runs = np.sort(decontaminate.window_hashes(item, decontaminate.RUN))
        for _ in range(30):
            copy = decontaminate.edited(item, e, rng)
            before, after = word(int(rng.integers(0, 40))), word(int(rng.integers(0, 40)))
            text = np.concatenate([before, copy, [decontaminate.PAD], after, [decontaminate.PAD]])
            value = decontaminate.window_hashes(text, decontaminate.RUN)
            hit = decontaminate.member(runs, value) & (value != decontaminate.PAD)
            place, begin = decontaminate.stretches(text, hit, [(n + e, decontaminate.shared_windows(n, e))])
            # an edit at its end may lie outside the best match
            d = [substring_distance(item.tolist(), text[place[a:b]].tolist()) for a, b in zip(begin, np.append(begin[1:], len(place)))]
            assert min(d) <= e
            kept, cut, origin = decontaminate.compact(text, place, begin)
            assert (kept[np.setdiff1d(np.arange(len(kept)), cut[1:] - 1)] == text[place]).all() and (kept[cut[1:] - 1] == decontaminate.PAD).all()
            assert (origin[:-1][kept[:-1] != decontaminate.PAD] == place).all()
