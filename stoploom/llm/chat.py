"""Conversations as training windows with a loss mask.

A conversation is cut into windows of a token budget at turn borders: running sums of turn tokens
choose how many new turns fit. Every window after the first repeats the opening system turn and a
limited history (at most ``HISTORY_TURNS`` turns and ``HISTORY_TOKENS`` tokens) before its new turns.
The loss mask holds the texts of new assistant turns only; repeated ones are context.

Each turn reads ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and texts get a
backslash after their first character; those that have backslashes there already get one more, so
taking one away gives the text back.

Rows stream through a task in order of conversation and turn: it holds one window and the history,
however long the conversation is.

Defined cases: a null role or text is empty; turns order by turn number, role and text, nulls
first; repeated rows are turns of their own; rows with a null conv_id form one conversation; a turn
over the budget has a window to itself, never cut; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches

BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
#: Tokens that the marks around a turn take.
MARKS = 4
#: The control strings that the template uses or that other templates give a meaning.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_PLAIN = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROLS))
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.DOTALL)

WINDOWS = "window long, text string, n_repeated int, loss array<struct<start: int, size: int>>"


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def tokens(text: str) -> int:
    """The size of a turn: its words and marks."""
    return len(text.split()) + MARKS


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text lies in it."""
    head, body = f"<s>{escape(role)}[INST]", escape(text)
    return f"{head}{body}[/INST]</s>", len(head), len(body)


class Cutter:
    """Turns of one conversation in, windows out."""

    def __init__(self, budget: int, history_turns: int, history_tokens: int):
        self.budget, self.history_turns, self.history_tokens = budget, history_turns, history_tokens
        self.system: tuple[str, str] | None = None
        self.context: list[tuple[str, str]] = []  # repeated turns of this window
        self.new: list[tuple[str, str]] = []
        self.before = 0  # running sum of tokens at the window's first new turn
        self.sum = 0  # and after its last
        self.number = 0
        self.seen = 0

    def _window(self) -> dict:
        text, loss = "", []
        for k, (role, body) in enumerate([*self.context, *self.new]):
            formatted, at, size = turn_text(role, body)
            if k >= len(self.context) and role == "assistant":
                loss.append({"start": len(text) + at, "size": size})
            text += formatted
        return {"window": self.number, "text": text, "n_repeated": len(self.context), "loss": loss}

    def _next(self) -> None:
        """The context of the next window: the system turn, and as much history as is allowed."""
        recent, used = [], 0
        past = [*self.context, *self.new]
        if self.system is not None and past and past[0] is self.system:
            past = past[1:]
        for turn in reversed(past):
            used += tokens(turn[1])
            if len(recent) == self.history_turns or used > self.history_tokens:
                break
            recent.insert(0, turn)
        self.context = ([] if self.system is None else [self.system]) + recent
        self.new, self.before = [], self.sum
        self.number += 1

    def add(self, role: str, text: str) -> Iterator[dict]:
        size = tokens(text)
        room = self.budget - sum(tokens(t) for _, t in self.context)
        if self.new and self.sum + size - self.before > room:
            yield self._window()
            self._next()
        turn = (role, text)
        if self.seen == 0 and role == "system":
            self.system = turn
        self.new.append(turn)
        self.sum += size
        self.seen += 1

    def end(self) -> Iterator[dict]:
        if self.new:
            yield self._window()


def windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """(conv_id, window, text, n_repeated, loss): the windows of each conversation, in order within a task.

    ``n_repeated`` turns at the front are context; ``loss`` are code point spans of ``text``."""
    small_batches(conversations.sparkSession)
    turns = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    shape = pa.schema(
        [("window", pa.int64()), ("text", pa.string()), ("n_repeated", pa.int32()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())])))]
    )

    def run(batches):
        cutter, conv, type_ = None, None, None
        out: list[dict] = []
        ids: list = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist(out, schema=shape)
            batch = pa.RecordBatch.from_arrays([pa.array(ids, type_), *made.columns], names=["conv_id", *shape.names])
            out.clear(), ids.clear()
            return batch

        weight = 0
        for batch in batches:
            type_ = batch.schema.field("conv_id").type
            rows = zip(*(batch.column(c) for c in ("conv_id", "role", "text")), strict=True)
            for found, role, text in ((c.as_py(), r.as_py() or "", t.as_py() or "") for c, r, t in rows):
                if cutter is None or found != conv:
                    for w in cutter.end() if cutter else ():
                        out.append(w), ids.append(conv)
                    cutter, conv = Cutter(budget, history_turns, history_tokens), found
                for w in cutter.add(role, text):
                    out.append(w), ids.append(conv)
                    weight += len(w["text"])
                if weight > 4 << 20:
                    yield flush()
                    weight = 0
        if cutter:
            for w in cutter.end():
                out.append(w), ids.append(conv)
            yield flush()

    return turns.mapInArrow(run, f"conv_id {kind}, {WINDOWS}")


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), parsed from windows.

    ``in_order``: the rows come as ``windows`` makes them, so that they need no further exchange."""
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    rows = formatted.select("conv_id", "window", "text", "n_repeated", "loss")
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        last, state, type_ = None, None, None
        out = []

        def close():
            n, turns, chars, loss, formatted = state
            out.append((last, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [type_, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", *names])

        for batch in batches:
            type_ = batch.schema.field("conv_id").type
            for row in zip(*(batch.column(c) for c in ("conv_id", "text", "n_repeated", "loss")), strict=True):
                conv, text, repeated, loss = (x.as_py() for x in row)
                if state is None or conv != last:
                    if state:
                        close()
                    last, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for k, turn in enumerate(_TURN.finditer(text)):
                    if k >= repeated:
                        state[0] += 1
                        state[1].update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
                for span in loss:
                    learned = unescape(text[span["start"] : span["start"] + span["size"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            yield flush()
        if state:
            close()
            yield flush()

    return rows.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
