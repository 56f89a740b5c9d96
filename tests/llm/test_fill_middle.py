"""Fill-in-middle against string slicing, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_data import documents, empty, texts
from pyspark.sql import functions as F

from tabprep.llm import fill_middle as fim


def expected(doc_id, text, plain_percent=10, spm_percent=20, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def awkward():
    return [*texts(7), "<P>", "x<M>", "a<P", ">b", "<S", "<<P", "<P<S", "S>", "<\n>", "<M", "<", ">", "P>", "é" * 50, "日a本b語", "a", "1"]


def test_equals_slicing(spark):
    own = awkward()
    df = documents(spark, [(i, t) for i, t in enumerate(own)] + [(0, own[0]), (None, own[5]), (None, None)])
    got = fim.fill_in_middle(df, keep=["doc_id", "id", "text"]).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
    assert {r.form for r in got} == set(fim.FORMS)
    other = fim.fill_in_middle(df, seed=9, plain_percent=0, spm_percent=50, keep=["doc_id", "text"]).collect()
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text, 0, 50, 9) for r in other)


def test_restores_every_text(spark):
    df = documents(spark, list(enumerate(awkward())))
    back = fim.restore(fim.fill_in_middle(df, keep=["doc_id", "text"], plain_percent=0)).collect()
    assert back and all(r.restored == (r.text or "") for r in back)
    d = fim.digests(fim.fill_in_middle(df)).join(df.select("doc_id", "text"), "doc_id").collect()
    assert all(r.restored_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in d)
    broken = spark.createDataFrame([(1, "psm", "<P>a<S>b")], "doc_id bigint, form string, output string")
    with pytest.raises(Exception, match="three sentinels"):
        fim.restore(broken).collect()


def test_kernels_on_random_blocks():
    rng = random.Random(5)
    for _ in range(60):
        rows = ["".join(rng.choice("ab <PS>Mé日\n") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        raw = [r.encode() for r in rows]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        units = fim.unit_starts(buf, off)
        assert np.diff(np.searchsorted(units, off)).tolist() == [len(re.findall(r"[A-Za-z]+|[^A-Za-z]", r)) for r in rows]
        held = fim.rows_with_marks(buf, off)
        assert held.tolist() == [any(s in r for s in fim.SENTINELS) for r in rows]
        form = np.array([0 if h else rng.randrange(3) for h in held])
        bounds = [np.append(units[(units >= a) & (units < b)], b) for a, b in zip(off[:-1], off[1:])]
        cuts = np.array([sorted(int(rng.choice(x)) for _ in range(2)) if f else [int(x[-1])] * 2 for x, f in zip(bounds, form)])
        out, out_off = fim.scatter(buf, off, cuts, form)
        back, back_off = fim.gather(out, out_off, form)
        assert back.tobytes() == buf.tobytes() and back_off.tolist() == off.tolist()


def test_clashes_and_empty_tables(spark):
    assert fim.digests(fim.fill_in_middle(empty(spark))).collect() == []
    with pytest.raises(ValueError, match="kept column"):
        fim.fill_in_middle(documents(spark), keep=["doc_id", "n"])
    plain = fim.fill_in_middle(documents(spark).withColumn("odd name.x", F.lit(1)), keep=["doc_id", "odd name.x"])
    assert plain.columns[1] == "odd name.x" and {r[1] for r in plain.collect()} == {1}
