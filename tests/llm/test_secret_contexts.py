"""The field on contexts and harmless lines that its fit has not: recall and
false alarms, with base spans as they were."""

import base64
import hashlib
import random
import uuid

import numpy as np
import pytest
from llm_data import documents, prose

from tabprep.llm import secret_scan

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.fixture(scope="module")
def field(spark):
    return secret_scan.fit_field(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def value(rng, low, high, of=LETTERS):
    return "".join(rng.choice(of) for _ in range(rng.randint(low, high)))


def jwt(rng):
    coded = lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("=")
    return ".".join([coded('{"alg":"HS256","typ":"JWT"}'), coded('{"sub":"%d","name":"%s"}' % (rng.randrange(10 ** 9), value(rng, 5, 12))), value(rng, 43, 43, LETTERS + "-_")])


HELD_OUT = {
    "bearer": lambda r: ("Authorization: Bearer ", value(r, 20, 40), ""),
    "passphrase": lambda r: ("passphrase ", value(r, 16, 30), ""),
    "url": lambda r: ("postgres://admin:", value(r, 14, 30), "@db.host/main"),
    "pwd": lambda r: ("pwd=", value(r, 14, 30), ""),
    "jwt": lambda r: ("sent ", jwt(r), ""),
}


def harmless(rng):
    kind = rng.randrange(8)
    return [f"/home/{prose(rng, 1)}/src/module_{rng.randrange(99)}.cpp", str(uuid.UUID(int=rng.getrandbits(128))), f"commit of {rng.randrange(10 ** 6)} lines in {rng.randrange(2000, 2030)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
            f"https://site{rng.randrange(99)}.net/a/b?page={rng.randrange(999)}", f"part no. {rng.randrange(10 ** 5)}-{rng.randrange(10 ** 4)}, {rng.randrange(99)}.{rng.randrange(99)}.{rng.randrange(99)}",
            base64.b64encode(prose(rng, 40).encode()).decode()[:rng.randint(180, 240)], f"computeTotalOf{prose(rng, 1).title()}({prose(rng, 1)}_{prose(rng, 1)})",
            "checksum " + hashlib.sha256(str(rng.random()).encode()).hexdigest().upper()][kind]


def found(spark, field, texts):
    got = {r.doc_id: r.spans for r in secret_scan.scan(documents(spark, list(enumerate(texts))), field, keep=["doc_id"]).collect()}
    return [[(kind, int(s), int(e)) for kind, s, e in (x.split(":") for x in got[k].split(",") if x)] for k in range(len(texts))]


def test_no_held_out_context_is_in_the_fit():
    for context in secret_scan.CONTEXTS:
        assert not any(w in context.lower() for w in ("bearer", "passphrase", "postgres", "pwd", "jwt"))


@pytest.mark.parametrize("kind", sorted(HELD_OUT))
def test_recall_on_held_out_contexts(spark, field, kind):
    rng, texts, want = random.Random(kind), [], []
    for _ in range(120):
        before, own, after = HELD_OUT[kind](rng)
        lead = prose(rng, 30) + " é "
        texts.append(f"{lead}{before}{own}{after} {prose(rng, 30)}")
        want.append((len(lead) + len(before), len(lead) + len(before) + len(own)))
    got = found(spark, field, texts)
    hits = sum(any((s, e) == w for _, s, e in g) for g, w in zip(got, want))
    assert hits >= 0.9 * len(want), hits
    assert sum(not (s < w[1] and e > w[0]) for g, w in zip(got, want) for _, s, e in g) <= 1


@pytest.mark.parametrize("kind,most", [("other", 0.01), ("made", 0.03)])
def test_false_alarms(spark, field, kind, most):
    """On lines of another make than the fit's, and on new ones of its own
    (which holds the hardest, ends of encoded prose, most often)."""
    rng, made = random.Random(8), np.random.default_rng(77)
    lines = [harmless(rng) if kind == "other" else secret_scan.made_harmless(made) for _ in range(800)]
    got = found(spark, field, [f"{prose(rng, 25)} {line} {prose(rng, 25)}" for line in lines])
    alarms = [lines[k] for k, g in enumerate(got) if any(x[0] == "crf" for x in g)]
    assert len(alarms) < most * len(lines), alarms


def test_clean_documents_and_base_spans_stay(spark, field):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text or "" for r in rows]
    for t, g in zip(texts, found(spark, field, texts)):
        base = [(secret_scan.KINDS[k], s, e) for s, k, e in secret_scan.base_spans(t)]
        assert [x for x in g if x[0] != "crf"] == base
        if not base:
            assert g == []


def test_made_lines_are_marked_where_they_stand():
    rng = np.random.default_rng(2)
    for k in range(200):
        text = "é some words and more of them " * (k % 4)
        raw, spans, harmless_ = secret_scan._with_lines(text, rng)
        assert len(harmless_) == 3 and len(spans) >= 3
        for s, e in spans:
            assert e - s >= 6 and b" " not in raw[s:e]
        for s, e in harmless_:
            assert 0 <= s < e <= len(raw)
        kept = raw.decode()
        for part in text.split():
            assert part in kept
