import hashlib
import re

from llm_data import documents, empty, prose
import random

from tabprep.llm import secret_scan

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [(m.start(2), 0, m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def corpus(n=120):
    rng = random.Random(2)
    out = []
    for k in range(n):
        kind = ['token = "%s"' % "".join(rng.choice("0123456789abcdef") for _ in range(40)), "AKIA" + "".join(rng.choice("ABCDEFGHIJ234567") for _ in range(16)), "password=" + "%016x" % rng.getrandbits(64), ""][k % 4]
        out.append(prose(rng, 40) + " é " + kind + " " + prose(rng, 40))
    return out


def test_base_spans_and_digest(spark):
    rows = list(enumerate([*corpus(), "ſecret=abcdefg", "PASSWORD : 'x' api_key='abcdef' Api-key=abcdef", "f" * 23, "f" * 24 + "g" + "0" * 30, "AKIA" * 10, None, ""]))
    df = documents(spark, rows)
    field = secret_scan.fit_field(df)
    got = {r.doc_id: r for r in secret_scan.scan(df, field, keep=["doc_id"]).collect()}
    for i, t in rows:
        want = brute(t or "")
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert got[i].base_sha256 == hashlib.sha256(secret_scan.written(want).encode()).hexdigest()
        assert set(secret_scan.written(want).split(",")) <= set(got[i].spans.split(",")) | {""}


def test_field_adds_other_shapes_and_spares_prose(spark):
    df = documents(spark, list(enumerate(corpus())))
    field = secret_scan.fit_field(df)
    rng = random.Random(9)
    new = [(1, 'ein key = "x8Kz9PqLmN3vB7wR2tY5aQ1Zs4" und'), *((k, prose(rng, 60)) for k in range(2, 40))]
    got = {r.doc_id: r.spans for r in secret_scan.scan(documents(spark, new), field, keep=["doc_id"]).collect()}
    assert got.pop(1).startswith("crf:")
    assert set(got.values()) == {""}


def test_viterbi_equals_full_search(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(50):
        field = secret_scan.Field(np.zeros((1, 3), np.float32), rng.normal(0, 2, (3, 3)).astype(np.float32))
        row = np.sort(rng.integers(0, 4, 30))
        e = rng.normal(0, 3, (30, 3)) + np.array([3.0, 0, 0])
        got = field.decode(e, row)
        for r in range(4):
            own, at = e[row == r], np.flatnonzero(row == r)
            if not len(at):
                continue
            s, back = own[0], []
            for x in own[1:]:
                m = s[:, None] + field.jump
                back.append(m.argmax(0))
                s = m.max(0) + x
            y = [int(s.argmax())]
            for b in back[::-1]:
                y.append(int(b[y[-1]]))
            assert got[at].tolist() == y[::-1]


def test_redact_keeps_columns(spark):
    df = documents(spark, [(1, 'é token = "0123456789abcdef" x'), (2, None), (3, "clean")])
    out = secret_scan.redact(df, None, length="n_chars")
    assert out.schema == df.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ('é token = "[SECRET]" x', 22), 2: (None, None), 3: ("clean", 5)}
    assert secret_scan.redact(empty(spark), None).collect() == []


def test_without_samples(spark):
    assert secret_scan.fit_field(empty(spark)) is None
    assert secret_scan.fit_field(documents(spark, [(1, "plain words")])) is None
    assert secret_scan.scan(empty(spark), None, keep=["doc_id"]).collect() == []
