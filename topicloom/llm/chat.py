"""Chat formatting in budgeted windows.

A conversation's turns are written under a template; control strings inside texts are
escaped reversibly.  With prefix sums of the turns' tokens a conversation is cut into
spans of whole turns that fit the budget.  Every window starts with the conversation's
system turn, then repeats as many of the last turns before its span as the history
budget holds, then brings the span.  The loss mask covers the assistant texts of the
span alone, so repeated targets are masked and each is learned once.  A system turn above a
half of the budget (``SYSTEM_SHARE``) stands in its own place only and is not repeated.

Rows stream through in order of conversation and turn; a window's worth of turns is all
that is held, so a conversation of any length passes.  A turn larger than the budget gets
a window of its own, over the budget.

A null text is empty, a null role too; a null conversation id is one conversation, null
turns come first; rows with one turn number are ordered by role and text, repeated rows are
turns of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm.common import slices

# The template, and control strings of public chat templates.
OPEN, CLOSE, BODY = "<|turn|>", "<|end|>", "\n"
CONTROL = [OPEN, CLOSE, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_ANY = "|".join(f"{re.escape(c[0])}(\\\\*){re.escape(c[1:])}" for c in CONTROL)
_PLAIN = re.compile(_ANY)
_ESCAPED = re.compile(_ANY.replace("(\\\\*)", "(\\\\+)"))


def escape(text: str) -> str:
    """A backslash after the first character of every control string, one more where there are some."""
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _role_out(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _role_in(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def write_turn(role: str, text: str) -> tuple[str, int]:
    """The turn under the template, and where its text begins."""
    head = f"{OPEN}{_role_out(role)}{BODY}"
    return f"{head}{escape(text)}{CLOSE}", len(head)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Turns written by ``write_turn``, one after the other."""
    out = []
    for part in formatted.split(OPEN)[1:]:
        role, _, rest = part.partition(BODY)
        out.append((_role_in(role), unescape(rest.removesuffix(CLOSE))))
    return out


#: A system turn above this part of the budget is not repeated.
SYSTEM_SHARE = 2
WINDOW_SCHEMA = (
    "conv_id long, window long, text string, new_from long, loss_starts array<long>, loss_ends array<long>, n_tokens long"
)


class _Windows:
    """The windows of one conversation, as its turns arrive."""

    def __init__(self, conv_id, budget: int, history: int, target: str):
        self.conv_id, self.budget, self.history, self.target = conv_id, budget, history, target
        self.system: tuple | None = None
        self.past: deque = deque()
        self.span: list = []
        self.past_end = self.end = self.number = 0

    def add(self, turn: tuple) -> dict | None:
        """``turn``: role, written, body start, tokens.  Returns the window that it closes."""
        head = self.system[3] if self.system else 0
        start = self.span[0][4] if self.span else self.end
        done = None
        # Prefix sums: a turn's own, from the conversation's start to the turn's, is its fifth field.
        if self.span and self.end + turn[3] - start + head > self.budget:
            done = self.window()
        if self.number == 0 and not self.span and self.system is None and turn[0] == "system" and turn[3] * SYSTEM_SHARE <= self.budget:
            self.system = (*turn, self.end)
        self.span.append((*turn, self.end))
        self.end += turn[3]
        return done

    def window(self) -> dict:
        """The window of the span so far; the span becomes history."""
        size = self.end - self.span[0][4]
        again = []
        if self.number:
            head = self.system[3] if self.system else 0
            room = min(self.history, self.budget - size - head)
            start = self.span[0][4]
            again = [t for t in self.past if start - t[4] <= room]
            if self.system:
                again = [self.system, *[t for t in again if t[4] != self.system[4]]]
        text, new_from = "".join(t[1] for t in again), sum(len(t[1]) for t in again)
        starts, ends, at = [], [], new_from
        for role, written, body, _, _ in self.span:
            if role == self.target:
                starts.append(at + body)
                ends.append(at + len(written) - len(CLOSE))
            at += len(written)
        row = {
            "conv_id": self.conv_id,
            "window": self.number,
            "text": text + "".join(t[1] for t in self.span),
            "new_from": new_from,
            "loss_starts": starts,
            "loss_ends": ends,
            "n_tokens": size + sum(t[3] for t in again),
        }
        self.past.extend(t for t in self.span if t[3] <= self.history)
        while self.past and self.end - self.past[0][4] > self.history:
            self.past.popleft()
        self.span, self.number = [], self.number + 1
        return row


_tokenizers: dict = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[path] = Tokenizer.from_file(path)
        _tokenizers[path].encode_special_tokens = True
    return _tokenizers[path]


def format_windows(
    conversations: DataFrame, tokenizer: str, budget: int = 2048, history: int = 512, target: str = "assistant"
) -> DataFrame:
    """One row per window, in order: text, where its new part begins, and the spans under the loss.

    The windows of a conversation leave one task one after the other.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer)
        schema = pa.schema([
            ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("new_from", pa.int64()),
            ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())), ("n_tokens", pa.int64()),
        ])
        current = None
        for batch in slices(batches, "text"):
            ids, roles = batch.column("conv_id").to_pylist(), batch.column("role").to_pylist()
            written = [write_turn(r, t) for r, t in zip(roles, batch.column("text").to_pylist())]
            sizes = [len(e.ids) for e in encode.encode_batch_fast([w for w, _ in written], add_special_tokens=False)]
            out = []
            for conv_id, role, (w, body), n in zip(ids, roles, written, sizes):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        out.append(current.window())
                    current = _Windows(conv_id, budget, history, target)
                if (done := current.add((role, w, body, n))) is not None:
                    out.append(done)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.window()], schema=schema)

    return ordered.mapInArrow(run, WINDOW_SCHEMA)


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read from their text and masks alone.

    ``windows`` is the frame that ``format_windows`` returns: its order is kept, so the
    digests run on over the windows as they come.
    """
    names = [f.split()[0] for f in DIGEST_SCHEMA.split(", ")]
    schema = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def result() -> list:
            conv_id, n, turns, loss_chars, loss, chars, windows = state
            return [conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, windows]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or row["window"] == 0:
                    if state is not None:
                        out.append(result())
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text in read_turns(row["text"][row["new_from"] :]):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for a, b in zip(row["loss_starts"], row["loss_ends"]):
                    text = unescape(row["text"][a:b])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(row["text"])
                state[6] += 1
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, result()))], schema=schema)

    return windows.mapInArrow(run, DIGEST_SCHEMA)
