"""Chat formatting in budgeted windows.

Conversations become training windows of at most ``budget`` tokens.  Prefix
sums of the turns' tokens choose the spans: a window starts at the first turn
not yet trained on, repeats a limited history before it, always repeats the
conversation's system turn, and ends at the last turn that still fits.  Loss
is taken on the assistant turns that are new in the window; repeated ones are
masked, so over all windows each assistant text is a target exactly once.

Template (``[INST] .. [/INST]`` marks a user's turn)::

    <s><<SYS>> text <</SYS>>[INST] text [/INST] text </s>[TURN] role [TURN] text [/TURN]

for system, user, assistant and any other role.  A control string inside a
text, with the backslashes before it, gets one backslash more; a mark of the
template follows a space or another mark, never a backslash.  So reading back
is exact for every text and role.

Scale: turns are dealt by (conversation, block of turn numbers), so one
conversation of any length spreads over tasks.  A window ends where a block
ends, at every size alike; a block's first window gets its history from copies
of the last turns of the block before (at most ``history_turns`` of ``block``
rows are copied) and the system turn from one marker row.  Within a task rows
stream in order and only the open window is held.

Defined cases: null texts and roles count as empty; rows of one turn number
are ordered system first, then by role and text; null turn numbers come first;
a null conversation id is a conversation; repeated rows stay.  The system turn
is the first row, if its role is ``system``.  A turn that does not fit into
the budget alone makes a longer window (``n_tokens`` says so): nothing is cut.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c as quoted

CONTROLS = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[TURN]", "[/TURN]")
_ANY = "|".join(map(re.escape, CONTROLS))
_BARE, _ESCAPED = re.compile(rf"\\*(?:{_ANY})"), re.compile(rf"\\(\\*(?:{_ANY}))")
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>|<<SYS>> (?P<system>.*?) <</SYS>>"
                   r"|\[TURN\] (?P<role>.*?) \[TURN\] (?P<other>.*?) \[/TURN\]", re.S)
_AROUND = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
BEGIN = "<s>"
NO_TURN = -(1 << 63)                                  # order value of a null turn number

WINDOW = "block bigint, window int, n_turns int, n_repeated int, n_tokens bigint, text string, targets array<struct<start:int,end:int>>"
_SLICE = 1 << 20                                      # code points given to the tokenizer at once


def escape(text: str) -> str:
    return _BARE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text starts and ends in it."""
    before, after = _AROUND.get(role) or (f"[TURN] {escape(role)} [TURN] ", " [/TURN]")
    body = escape(text)
    return before + body + after, len(before), len(before) + len(body)


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of every turn of a window; start and end are
    those of its escaped text."""
    if not window.startswith(BEGIN):
        raise ValueError("a window begins with <s>")
    at, out = len(BEGIN), []
    while at < len(window):
        m = _TURN.match(window, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        role = unescape(m["role"]) if kind == "other" else kind
        out.append((role, unescape(m[kind]), m.start(kind), m.end(kind)))
        at = m.end()
    return out


# --- choosing spans -------------------------------------------------------------

def next_span(total: np.ndarray, users: np.ndarray, first: int, room: int, history_turns: int, history_tokens: int) -> tuple[int, int]:
    """(start, end) of the window whose first new turn is ``first``.

    ``total`` are the prefix sums of the turns' tokens (one more than turns),
    ``users`` the ascending places of user turns.  The history is the longest
    run of turns before ``first`` within both limits that leaves room for
    ``first`` and starts at a user's turn; the window ends at the last turn
    that fits, and has one new turn at least."""
    start = max(first - history_turns, 0, int(np.searchsorted(total, total[first] - history_tokens)), int(np.searchsorted(total, total[first + 1] - room)))
    k = int(np.searchsorted(users, start))
    start = min(first, int(users[k]) if k < len(users) else first)
    return start, max(int(np.searchsorted(total, total[start] + room, "right")) - 1, first + 1)


class _Open:
    """The turns of one block that are not yet written, and what they may repeat."""

    def __init__(self, conv, block, budget: int, history_turns: int, history_tokens: int):
        self.conv, self.block = conv, block
        self.budget, self.history_turns, self.history_tokens = budget, history_turns, history_tokens
        self.system: tuple[str, int] | None = None
        self.system_is_new, self.decided = False, False
        self.turns: list[tuple[str, tuple[str, int, int], int]] = []      # role, rendered turn, tokens
        self.first = self.windows = self.waiting = 0

    def add(self, kind: int, role: str, turn: tuple[str, int, int], cost: int) -> None:
        """kind: 0 marker (with the system turn, or of role ''), 1 history, 2 new."""
        if not self.decided:                          # the first row says whether the conversation starts here
            self.decided = True
            if role == "system" and kind in (0, 2):
                self.system, self.system_is_new = (turn[0], cost), kind == 2
                return
        if kind == 0 or kind == 1 and self.system and self.system[0] == turn[0]:
            return                                    # the marker; or the system turn, which is there already
        if kind == 1:
            self.first += 1
        else:
            self.waiting += cost
        self.turns.append((role, turn, cost))

    def _window(self, start: int, first: int, end: int) -> tuple:
        parts, at, targets, tokens = [BEGIN], len(BEGIN), [], 0
        repeated, n = first - start, end - start
        if self.system:
            parts.append(self.system[0])
            at, tokens, n = at + len(self.system[0]), self.system[1], n + 1
            repeated += not self.system_is_new
        for k in range(start, end):
            role, (text, a, b), cost = self.turns[k]
            if role == "assistant" and k >= first:
                targets.append((at + a, at + b))
            parts.append(text)
            at, tokens = at + len(text), tokens + cost
        self.windows, self.system_is_new = self.windows + 1, False
        return self.conv, self.block, self.windows - 1, n, repeated, tokens, "".join(parts), targets

    def close(self, end_of_block: bool) -> Iterator[tuple]:
        """Windows that no later turn can change; all of them at the end."""
        total = np.concatenate([[0], np.cumsum([t[2] for t in self.turns], dtype=np.int64)])
        users = np.flatnonzero([t[0] == "user" for t in self.turns])
        room = self.budget - (self.system[1] if self.system else 0)
        while self.first < len(self.turns):
            start, end = next_span(total, users, self.first, room, self.history_turns, self.history_tokens)
            if end == len(self.turns) and not end_of_block:
                break
            yield self._window(start, self.first, end)
            self.first = end
        if end_of_block and self.system_is_new:       # nothing but a system turn
            yield self._window(len(self.turns), len(self.turns), len(self.turns))
        drop = max(0, self.first - self.history_turns)
        self.turns, self.first = self.turns[drop:], self.first - drop
        self.waiting = sum(t[2] for t in self.turns[self.first:])


def _token_counter(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True            # their strings inside texts are ordinary text

    def count(texts: list[str]) -> list[int]:
        out, k = [], 0
        while k < len(texts):
            end, size = k, 0
            while end < len(texts) and (end == k or size + len(texts[end]) <= _SLICE):
                size, end = size + len(texts[end]), end + 1
            out += [len(e) for e in tokenizer.encode_batch_fast(texts[k:end], add_special_tokens=False)]
            k = end
        return out

    return count


def _dealt(turns: DataFrame, block: int, history_turns: int) -> DataFrame:
    """Rows (conv, block, kind, turn, role, text), a block being named by the
    turn number it begins with: the new turns of each block, the history copied from the block before, and a marker with the system
    turn (role '' if there is none) for blocks that do not start the conversation."""
    begin = F.col("turn") - F.pmod(F.col("turn"), F.lit(block))
    rows = turns.select("conv", F.when(F.col("turn") == NO_TURN, NO_TURN).otherwise(begin).alias("block"), "turn", "role", "text")
    new = rows.withColumn("kind", F.lit(2))
    late = rows.where((F.col("turn") != NO_TURN) & (F.pmod(F.col("turn"), F.lit(block)) >= block - history_turns))
    held = rows.groupBy("conv", "block").agg(F.min("turn").alias("turn"))
    begins = held.groupBy("conv").agg(F.min("turn").alias("begin"), F.min("block").alias("begin_block"), F.count("*").alias("blocks")).where("blocks > 1")
    begins = begins.select(F.col("conv").alias("own"), "begin", "begin_block")
    here = F.col("conv").eqNullSafe(F.col("own"))
    system = rows.where("role = 'system'").join(begins, here & (F.col("turn") == F.col("begin"))).groupBy(F.col("own").alias("who")).agg(F.min("text").alias("text"))
    later = held.join(begins, here & (F.col("block") > F.col("begin_block"))).select("conv", "block")
    markers = later.join(system, F.col("conv").eqNullSafe(F.col("who")), "left").select(
        "conv", "block", F.lit(NO_TURN).alias("turn"), F.when(F.col("text").isNull(), "").otherwise("system").alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("kind"))
    # history is wanted only where a later block exists
    following = later.select(F.col("conv").alias("own"), F.col("block").alias("next"))
    history = late.join(following, here & (F.col("block") + block == F.col("next"))).select("conv", F.col("next").alias("block"), "turn", "role", "text", F.lit(1).alias("kind"))
    return new.unionByName(history).unionByName(markers)


def format_windows(conversations: DataFrame, tokenizer_path: str, *, budget: int = 2048, history_turns: int = 4,
                   history_tokens: int = 512, block: int = 256, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """One row per window: the conversation's id, ``block`` and ``window``
    (their order is the conversation's), turns and repeated turns in it,
    tokens, the formatted ``text``, and the loss mask ``targets`` in code
    points of it.  ``tokenizer_path``: a file of the tokenizers library."""
    if not 0 <= history_turns < block:
        raise ValueError("history_turns is at least 0 and less than block")
    turns = conversations.select(quoted(conv).alias("conv"), F.coalesce(quoted(turn).cast("bigint"), F.lit(NO_TURN)).alias("turn"),
                                 F.coalesce(quoted(role).cast("string"), F.lit("")).alias("role"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    rows = _dealt(turns, block, history_turns)
    rows = rows.select("conv", "block", "kind", "role", "text", "turn").repartition("conv", "block").sortWithinPartitions(
        "conv", "block", "kind", "turn", F.col("role") != "system", "role", "text").drop("turn")
    out_type = f"`{conv}` {turns.schema['conv'].dataType.simpleString()}, {WINDOW}"
    conv_type = turns.schema["conv"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, open_, made, size, started = _token_counter(tokenizer_path), None, [], 0, False
        for batch in batches:
            convs, blocks_, kinds, roles, texts = (batch.column(i).to_pylist() for i in range(5))
            rendered = [render(r, t) for r, t in zip(roles, texts)]
            for key, b, kind, r, turn_, cost in zip(convs, blocks_, kinds, roles, rendered, count([x[0] for x in rendered])):
                if not started or key != open_.conv or b != open_.block:
                    if started:
                        made += open_.close(True)
                    open_, started = _Open(key, b, budget, history_turns, history_tokens), True
                open_.add(kind, r, turn_, cost)
                size += len(turn_[0])
                if open_.waiting > 2 * budget:
                    made += open_.close(False)
                if size > _SLICE:
                    yield _windows(made, conv, conv_type)
                    made, size = [], 0
        if started:
            made += open_.close(True)
        yield _windows(made, conv, conv_type)

    return rows.mapInArrow(run, out_type)


def _windows(made: list[tuple], conv: str, conv_type) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type
    own = list(zip(*made)) if made else [()] * 8
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    types = [to_arrow_type(conv_type), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), spans]
    own = [*own[:7], [[{"start": a, "end": b} for a, b in t] for t in own[7]]]
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(own, types)], names=[conv, "block", "window", "n_turns", "n_repeated", "n_tokens", "text", "targets"])


# --- reading back ----------------------------------------------------------------

def read_turns(windows: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """(conversation, block, window, place, role, text, target) of every turn
    that is new in its window, from the formatted text and the mask alone."""
    out_type = f"`{conv}` {windows.schema[conv].dataType.simpleString()}, block bigint, window int, place int, role string, text string, target boolean"
    from_arrow = ["block", "window", "place", "role", "text", "target"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            took, out = [], []
            for i, (b, w, skip, text, targets) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 6)))):
                spans = {(t["start"], t["end"]) for t in targets}
                for place, (role, said, start, end) in enumerate(parse(text)[skip:]):
                    took.append(i)
                    out.append((b, w, place, role, said, (start, end) in spans))
            types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            own = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(took, pa.int64())), *(pa.array(list(x), t) for x, t in zip(own, types))], names=[conv, *from_arrow])

    return windows.select(quoted(conv).alias("conv"), "block", "window", "n_repeated", "text", "targets").mapInArrow(run, out_type)


def digests(windows: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its windows: turns, the digest of all
    turns, length and digest of all text under the mask, code points of the
    windows.  A digest is sequential, so a conversation streams through one
    task, one window at a time."""
    conv_type = windows.schema[conv].dataType
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    out_type = f"`{conv}` {conv_type.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        types = [to_arrow_type(conv_type), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def ended(done: list[tuple]) -> pa.RecordBatch:
            own = list(zip(*done)) if done else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(own, types)], names=names)

        key, started, done = None, False, []
        for batch in batches:
            for own, skip, text, targets in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not started or own != key:
                    if started:
                        done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))
                    key, started, n, chars, formatted, turns, loss = own, True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, said, _, _ in parse(text)[skip:]:
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for t in targets:
                    said = unescape(text[t["start"]:t["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                formatted += len(text)
            yield ended(done)
            done = []
        if started:
            done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))
        yield ended(done)

    rows = windows.select(quoted(conv).alias("conv"), "n_repeated", "text", "targets", "block", "window")
    return rows.repartition("conv").sortWithinPartitions("conv", "block", "window").drop("block", "window").mapInArrow(run, out_type)
