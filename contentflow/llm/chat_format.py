"""Chat formatting with budgeted windows.

A turn is written as ``<turn ROLE>TEXT</turn>\\n``; inside role and text the
characters ``\\``, ``<`` and ``>`` get a backslash, so no control string can occur
there and the text comes back exactly.

Running sums of the turns' token counts choose the windows: the system turn (a
conversation's first turn, if its role is ``system``) opens every window, then come
whole turns of history (the last ones before the window, ``history`` tokens at most, not
trained on again), then the window's own turns, as many as ``budget`` allows, one at
least.  The loss mask covers the texts of the window's own assistant turns.

Turns are never cut: a turn (with the system turn) over the budget has a window of its
own, flagged ``over``.  Conversations are streamed in turn order; a task holds the turns of
one window and its history, whatever the conversation's length.

Defined cases: a null text is empty; a null role is the empty role; turns with the same
number stand by role, then text, repeated rows included; rows without conv_id are one
conversation, rows without turn number come first.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import save, text_slices
from contentflow.llm.tokens import encoder

SPECIAL = re.compile(r"[\\<>]")
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)
TARGET = "assistant"


def escape(text: str) -> str:
    return SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's formatted text, and where its (escaped) text begins and ends."""
    head = f"<turn {escape(role)}>"
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


class Windows:
    """Feeds on the turns of one conversation, in order, and gives its windows."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system = None  # (role, text, tokens)
        self.own = []  # turns of the window being filled
        self.past = deque()  # (turn, running sum before it) of the turns before it
        self.total = 0  # running sum of the tokens of all turns but the system turn
        self.begin = 0  # its value where the window's own turns begin
        self.count = 0
        self.seen = 0

    def add(self, role: str, text: str, tokens: int):
        self.seen += 1
        if self.seen == 1 and role == "system":
            self.system = (role, text, tokens)
            return
        if self.own and self._fixed() + self.total + tokens - self.begin > self.budget:
            yield self.window()
        self.own.append(((role, text, tokens), self.total))
        self.total += tokens

    def _fixed(self) -> int:
        """Tokens of the system turn and of the history."""
        return (self.system[2] if self.system else 0) + (self.begin - self.past[0][1] if self.past else 0)

    def window(self) -> dict:
        """Close the window; its last turns become the next one's history."""
        repeats = ([self.system] if self.system else []) + [t for t, _ in self.past]
        parts, spans, at = [], [], 0
        for k, (role, text, _) in enumerate(repeats + [t for t, _ in self.own]):
            out, a, b = render(role, text)
            if k >= len(repeats) and role == TARGET:
                spans.append((at + a, at + b))
            parts.append(out)
            at += len(out)
        tokens = self._fixed() + self.total - self.begin
        # The first window repeats nothing: its system turn is given for the first time.
        known = len(repeats) if self.count else 0
        made = {"window": self.count, "text": "".join(parts), "n_tokens": tokens, "known": known, "over": tokens > self.budget,
                "starts": [a for a, _ in spans], "ends": [b for _, b in spans]}
        self.past.extend(self.own)
        while self.past and self.total - self.past[0][1] > self.history:
            self.past.popleft()
        self.own, self.begin, self.count = [], self.total, self.count + 1
        return made

    def end(self):
        if self.own or (self.system and self.count == 0):
            yield self.window()


def _count_tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 20):
                made = pa.array([render(r, t)[0] for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())], pa.string())
                offsets, _ = words.encode(made)
                yield batch.append_column("tokens", pa.array(np.diff(offsets), pa.int64()))
    return run


def _format(budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv = None, None
        for batch in batches:
            made = []
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens")]
            for c, role, text, tokens in zip(*cols):
                if now is None or c != conv:
                    if now is not None:
                        made += [{"conv_id": conv, **w} for w in now.end()]
                    now, conv = Windows(budget, history), c
                made += [{"conv_id": conv, **w} for w in now.add(role, text, tokens)]
            if made:
                yield pa.RecordBatch.from_pylist(made, ROWS)
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, **w} for w in now.end()], ROWS)
    return run


ROWS = pa.schema([("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()),
                  ("known", pa.int64()), ("over", pa.bool_()), ("starts", pa.list_(pa.int64())),
                  ("ends", pa.list_(pa.int64()))])
WINDOWS = ("conv_id long, window long, text string, n_tokens long, known long, over boolean, "
           "starts array<long>, ends array<long>")


def format_conversations(turns: DataFrame, vocabulary: str, budget: int = 1024, history: int = 256) -> DataFrame:
    """Windows of ``turns(conv_id, turn, role, text)``: ``conv_id, window, text,
    n_tokens, known, over, starts, ends``.

    ``known``: so many turns at the start were given in earlier windows.
    ``starts``/``ends``: the loss mask as code point spans of ``text``.
    """
    clean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    turn = dict(turns.dtypes)["turn"]
    counted = clean.mapInArrow(_count_tokens(vocabulary), f"conv_id long, turn {turn}, role string, text string, tokens long")
    ordered = counted.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(_format(budget, history), WINDOWS)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The turns of a window's text."""
    out, at = [], 0
    for m in TURN.finditer(text):
        if m.start() != at:
            raise ValueError("text between turns")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("text after the last turn")
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state = None

    def row():
        conv, turns, sha, loss, loss_sha, chars = state
        return (conv, turns, sha.hexdigest(), loss, loss_sha.hexdigest(), chars)

    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if state is None or state[0] != r["conv_id"]:
                if state is not None:
                    done.append(row())
                state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(r["text"])[r["known"]:]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for a, b in zip(r["starts"], r["ends"]):
                text = unescape(r["text"][a:b])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(r["text"])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(), kinds)], names)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """A row per conversation, read from its windows in order."""
    ordered = windows.select("conv_id", "window", "text", "known", "starts", "ends").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "window")
    return ordered.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long")


def chat_report(turns: DataFrame, vocabulary: str, budget: int = 1024, history: int = 256) -> DataFrame:
    """Format, write, read back and digest."""
    return conversation_digests(save(format_conversations(turns, vocabulary, budget, history), "chat"))
