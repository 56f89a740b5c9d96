"""The sample of the secrets' field: distinct texts, flagged as the base patterns say."""

import random

from llm_data import documents, prose

from tabprep.llm import secret_scan


def test_copies_and_short_values_do_not_fill_the_sample(spark):
    rng = random.Random(4)
    flagged = [prose(rng, 30) + f' token = "{rng.getrandbits(160):040x}" ' + prose(rng, 30) for _ in range(12)]
    clean = [prose(rng, 60) for _ in range(40)]
    short = [f"{prose(rng, 10)} token = abc{k % 10}" for k in range(30)]       # no base span: under six characters
    want = secret_scan.fit_field(documents(spark, list(enumerate(flagged + clean))), sample_rows=40)
    copied = flagged + clean + short + short[:4] * 60 + flagged[:6] * 60
    got = secret_scan.fit_field(documents(spark, list(enumerate(copied))), sample_rows=40)
    assert want is not None and got is not None
    probe = documents(spark, [(k, t) for k, t in enumerate(flagged)])
    assert all("assign" in r.spans for r in secret_scan.scan(probe, got, keep=["doc_id"]).collect())


def test_copies_change_nothing(spark):
    rng = random.Random(6)
    flagged = [prose(rng, 30) + f' token = "{rng.getrandbits(160):040x}" ' + prose(rng, 30) for _ in range(12)]
    rest = [prose(rng, 60) for _ in range(40)]
    once = secret_scan.fit_field(documents(spark, list(enumerate(flagged + rest))), sample_rows=12)
    often = secret_scan.fit_field(documents(spark, list(enumerate(flagged + [t for t in flagged + rest for _ in range(30)] + rest))), sample_rows=12)
    assert (once.weight == often.weight).all() and (once.jump == often.jump).all()
    only_short = [f"{prose(rng, 10)} token = abc{k % 10}" for k in range(30)]
    mixed = secret_scan.fit_field(documents(spark, list(enumerate(only_short + flagged))), sample_rows=12)
    assert mixed is not None and any(mixed.weight[:, 1] != 0)
