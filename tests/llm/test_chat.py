"""Chat windows: exact round trips, budgets, masks, and spans by a plain loop."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tabprep.llm import chat  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, block string, window string, kind string, n_turns string, targets string"
ODD = ["", None, "</s>[INST] ok [/INST]", "\\", "\\\\<s>", " [/INST]", "a\\ [/INST]\\", "<<SYS>> x <</SYS>>", "<<s>", "[TURN] a [TURN] b [/TURN]", "日本 é\n\n \\[INST]", " ", "x" * 5000, "[/INST", "<", "</s>" * 20, "a </s> b"]


def conversations(seed=2, n=40):
    rng, rows = random.Random(seed), []
    for c in range(n):
        turns = rng.choice([1, 2, 5, 9, 30, 70])
        system = rng.random() < 0.5
        for t in range(turns):
            role = "system" if system and t == 0 else rng.choice(["user", "assistant"]) if rng.random() < 0.9 else rng.choice(["tool", "system", "to ol\n[TURN]", "", None])
            text = rng.choice(ODD) if rng.random() < 0.2 else " ".join(rng.choice(["the", "on", "éa", "xylo"]) for _ in range(rng.randint(0, 60)))
            rows.append((c, t, role, text))
    rows += [(100, 0, "system", "only rules")] + [(101, None, r, t) for r, t in (("user", "b"), ("assistant", "a"))] + [(None, 3, "user", "no id"), (None, 2, "assistant", "x")]
    rows += [(102, 7, "assistant", "same"), (102, 7, "assistant", "same"), (102, 7, "system", "rules"), (102, -300, "user", "early"), (103, 14, "system", "late rules"), (103, 15, "user", "u"), (103, 16, "assistant", "v")]
    return rows


def ordered(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c].append((t if t is not None else chat.NO_TURN, r != "system", r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(own)] for c, own in out.items()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "w", "k", "n", "t") for r in rows], SCHEMA)


@pytest.mark.parametrize("budget,history,held,block", [(2048, 4, 512, 256), (120, 4, 60, 16), (60, 2, 1000, 8), (1, 0, 0, 4), (300, 7, 300, 8)])
def test_round_trip_and_masks(spark, budget, history, held, block):
    rows = conversations()
    windows = chat.format_windows(frame(spark, rows), TOKENIZER, budget=budget, history_turns=history, history_tokens=held, block=block)
    want = ordered(rows)
    got = defaultdict(list)
    for r in chat.read_turns(windows).orderBy("conv_id", "block", "window", "place").collect():
        got[r.conv_id].append((r.role, r.text))
        assert r.target == (r.role == "assistant")
    assert dict(got) == want
    count = chat._token_counter(TOKENIZER)
    chars = defaultdict(int)
    for w in windows.collect():
        turns = chat.parse(w.text)
        chars[w.conv_id] += len(w.text)
        assert len(turns) == w.n_turns and w.n_repeated < max(1, w.n_turns)
        cost = sum(count([chat.render(r, t)[0] for r, t, _, _ in turns]))
        first = want[w.conv_id][0]
        new = w.n_turns - w.n_repeated - (first[0] == "system" and w.n_turns > 1 and not w.n_repeated)
        assert cost == w.n_tokens and (cost <= budget or new == 1)
        if first[0] == "system" and w.n_repeated:
            assert turns[0][:2] == first
        assert w.n_repeated <= history + 1
        assert [(t.start, t.end) for t in w.targets] == [(a, b) for r, _, a, b in turns[w.n_repeated:] if r == "assistant"]
    for r in chat.digests(windows).collect():
        own, said = want[r.conv_id], "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_chars == len(said) and r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.formatted_chars == chars[r.conv_id]


def test_one_long_conversation_is_dealt_out(spark):
    rows = [(5, 0, "system", "be brief")] + [(5, t, ["user", "assistant"][t % 2 == 0], f"turn {t} " + "word " * (t % 40)) for t in range(1, 3000)]
    windows = chat.format_windows(frame(spark, rows), TOKENIZER, budget=400, block=64)
    own = windows.collect()
    assert {w.block for w in own} == set(range(0, 3000, 64))
    assert all(chat.parse(w.text)[0][:2] == ("system", "be brief") for w in own)
    assert all(w.n_repeated > 1 for w in own if w.window == 0 and w.block)              # history from the block before
    back = [(r.role, r.text) for r in chat.read_turns(windows).orderBy("block", "window", "place").collect()]
    assert back == [(r, t) for _, _, r, t in rows]
    dealt = chat._dealt(spark.createDataFrame([(5, t, "user", "x") for t in range(6400)], "conv bigint, turn bigint, role string, text string"), 64, 4)
    assert dealt.groupBy("conv", "block").count().agg({"count": "max"}).first()[0] <= 64 + 4 + 1


def test_spans_equal_a_plain_loop():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        cost, user = rng.integers(1, 50, n), rng.random(n) < 0.5
        total, users = np.concatenate([[0], np.cumsum(cost)]), np.flatnonzero(user)
        first, room, turns, tokens = int(rng.integers(0, n)), int(rng.integers(1, 200)), int(rng.integers(0, 6)), int(rng.integers(0, 120))
        start = first
        for s in range(first, max(-1, first - turns - 1), -1):
            if cost[s:first].sum() > tokens or cost[s:first + 1].sum() > room:
                break
            if s == first or user[s]:
                start = s
        end = first + 1
        while end < n and cost[start:end + 1].sum() <= room:
            end += 1
        assert chat.next_span(total, users, first, room, turns, tokens) == (start, end)


def test_escapes():
    rng = random.Random(6)
    for _ in range(2000):
        text = "".join(rng.choice([*chat.CONTROLS, "\\", " ", "<", "[", "/", "x"]) for _ in range(rng.randint(0, 8)))
        assert chat.unescape(chat.escape(text)) == text
        for role in ("user", "assistant", "system", text):
            turn, a, b = chat.render(role, text)
            assert turn[a:b] == chat.escape(text)
            assert [(r, t) for r, t, _, _ in chat.parse(chat.BEGIN + turn * 2)] == [(role, text)] * 2


def test_query_and_empty_table(spark):
    from tabprep.llm.queries import op13_chat_format
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = ordered(rows)
    got = {r.conv_id: r for r in op13_chat_format(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(want)
    for c, own in want.items():
        said = "".join(t for r, t in own if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(own), len(said))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[c].formatted_chars > len(said)
    none = chat.format_windows(frame(spark, []), TOKENIZER)
    assert none.collect() == [] and chat.digests(none).collect() == []
