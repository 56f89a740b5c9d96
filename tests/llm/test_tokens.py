import hashlib

import pytest
from llm_data import documents, empty, texts

public_tokenizers = pytest.importorskip("public_tokenizers")
from tabprep.llm import pieces, token_counts  # noqa: E402

WORD, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORD)
    df = documents(spark)
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    want = sorted(((i, len(t.encode()), n, n > 2048) for (i, t), n in zip(rows, (len(tok.encode(t, add_special_tokens=False).ids) for _, t in rows))), key=str)
    got = sorted((tuple(r) for r in token_counts.count_tokens(df, WORD).collect()), key=str)
    assert got == want
    # a tiny table and cache change nothing
    small = token_counts.count_tokens(df, WORD, sample_rows=3, table_size=8, cache_size=5)
    assert sorted((tuple(r) for r in small.collect()), key=str) == want
    assert token_counts.count_tokens(empty(spark), WORD).collect() == []


def test_pieces_equal_the_library(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    df = documents(spark)
    want = []
    for r in df.collect():
        ids = model.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    got = [tuple(r) for r in pieces.encode_decode(df, PIECE, digests=True).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    plain = pieces.encode_decode(df, PIECE, keep=["doc_id", "id"]).collect()
    assert {tuple(r.token_ids) for r in plain} == {tuple(model.encode(t or "")) for t in texts()}
    assert pieces.encode_decode(empty(spark), PIECE).collect() == []
    with pytest.raises(ValueError):
        pieces.encode_decode(df.withColumnRenamed("n", "N_tokens"), PIECE, keep=["N_tokens"])


def test_merge_rounds_on_random_symbols():
    import random

    import sentencepiece
    model, own, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE), pieces.Encoder(PIECE, cache_size=50), random.Random(3)
    some = ["".join(rng.choice("   thernoaiut\n.é☃0<>▁日") for _ in range(rng.randint(0, 50))) for _ in range(400)] + ["abab" * 400, "a" * 3000]
    for k in range(0, len(some), 40):
        assert [x.tolist() for x in own.encode(some[k:k + 40])] == model.encode(some[k:k + 40])


def test_decode_of_any_ids():
    import random

    import numpy as np
    import sentencepiece
    model, own, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE), pieces.PieceModel(PIECE), random.Random(4)
    for _ in range(300):
        ids = [rng.choice([*range(3, 259), *range(259, 2000)]) for _ in range(rng.randint(1, 12))]
        ids[0] = rng.randint(300, 2000)
        assert own.decode(np.array(ids)) == model.decode(ids)
