"""Chat formatting in budgeted windows.

A conversation becomes windows of whole turns: running sums of turn tokens give
the longest span of new turns that fits ``budget`` together with what a window
repeats, its system turn and the last turns before it (``history_turns`` turns
of at most ``history_tokens`` tokens). A turn larger than the budget gets a
window of its own, in which nothing but the system turn is repeated; a system turn
larger than the budget is given once, masked, in a first window of its own and is not
repeated. So a window is over the budget by one turn at most, and nothing is cut.
Loss spans cover the text of each assistant
turn where it is new; repeated turns are masked.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Texts and roles are escaped
reversibly (``\\`` as ``\\\\``, ``<|`` as ``<\\|``, a newline in a role as ``\\n``),
so that control strings inside them cannot mark a turn.

Rows are dealt by conversation and sorted by turn, then streamed: a task holds
one window, however long a conversation is.

Defined results: a null text or role is empty; rows of one turn number are
ordered by role and text, null turns come first, repeated rows are turns of
their own; a null conv_id is a conversation; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 512, 2, 128
OVERHEAD = 4  # tokens that the template adds to a turn
START, END = "<|im_start|>", "<|im_end|>"
_TOKEN = re.compile(r"\w+|[^\w\s]")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_WINDOWS = ("conv_id long, window long, text string, turns int, first_new int, system_new boolean, "
            "loss_starts array<long>, loss_ends array<long>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def count_tokens(text: str) -> int:
    return len(_TOKEN.findall(text)) + OVERHEAD


class _Conversation:
    """Cuts one conversation's stream of turns into windows."""

    def __init__(self, conv_id, budget: int, history_turns: int, history_tokens: int):
        self.conv_id, self.budget, self.history_tokens = conv_id, budget, history_tokens
        self.system = None
        self.recent: deque = deque(maxlen=history_turns or None)
        self.history_turns = history_turns
        self.window, self.started = 0, False
        self.begin()

    def begin(self) -> None:
        """A new window: what it repeats, and the running token sum."""
        self.new: list = []
        self.repeated: list = []
        if self.started and self.history_turns:
            left = self.history_tokens
            for turn in reversed(self.recent):
                if turn[2] > left:
                    break
                left -= turn[2]
                self.repeated.insert(0, turn)
        self.total = sum(t[2] for t in self.repeated) + (self.system[2] if self.system else 0)

    def add(self, role: str, text: str) -> dict | None:
        turn = (role, text, count_tokens(text))
        if not self.started and role == "system":
            self.started = True
            if turn[2] > self.budget:
                self.new.append(turn)
                done = self.close()
                self.begin()
                return done
            self.system, self.total = turn, turn[2]
            return None
        self.started = True
        done = None
        if self.total + turn[2] > self.budget:
            if self.new:
                done = self.close()
                self.begin()
            while self.repeated and self.total + turn[2] > self.budget:
                self.total -= self.repeated.pop(0)[2]  # history gives way to a large turn
        self.new.append(turn)
        self.total += turn[2]
        if self.history_turns:
            self.recent.append(turn)
        return done

    def close(self) -> dict | None:
        if not self.started or (not self.new and self.window):
            return None
        parts, starts, ends, at = [], [], [], 0
        turns = ([self.system] if self.system else []) + self.repeated + self.new
        first_new = len(turns) - len(self.new)
        for k, (role, text, _) in enumerate(turns):
            head, body = f"{START}{escape(role)}\n".replace("\n", "\\n", escape(role).count("\n")), escape(text)
            if k >= first_new and role == "assistant":
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts.append(f"{head}{body}{END}\n")
            at += len(parts[-1])
        row = {"conv_id": self.conv_id, "window": self.window, "text": "".join(parts), "turns": len(turns), "first_new": first_new,
               "system_new": self.system is not None and self.window == 0, "loss_starts": starts, "loss_ends": ends}
        self.window += 1
        return row


def _arrow(rows: list[dict]) -> pa.RecordBatch:
    types = {"conv_id": pa.int64(), "window": pa.int64(), "text": pa.string(), "turns": pa.int32(), "first_new": pa.int32(),
             "system_new": pa.bool_(), "loss_starts": pa.list_(pa.int64()), "loss_ends": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types.items()], names=list(types))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                 history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """One row per window: its formatted text, number of turns, index of the first new
    turn, whether the system turn is new in it, and the loss spans (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, rows, size = None, [], 0
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if conv is None or conv.conv_id != c:
                    if conv is not None:
                        rows.append(conv.close())
                    conv = _Conversation(c, budget, history_turns, history_tokens)
                done = conv.add(role or "", text or "")
                if done:
                    rows.append(done)
                    size += len(done["text"])
                if size > 1 << 22 or len(rows) > 4000:
                    yield _arrow([r for r in rows if r])
                    rows, size = [], 0
        if conv is not None:
            rows.append(conv.close())
        if rows := [r for r in rows if r]:
            yield _arrow(rows)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, _WINDOWS))


def parse_window(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


_REPORT = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_windows long")


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted windows alone. ``windows`` is
    streamed in the order in which ``chat_windows`` makes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = None, []

        def ended():
            conv, n, turns, chars, loss, formatted, count = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, count
        for batch in batches:
            for w in batch.to_pylist():
                if state is None or w["window"] == 0:
                    if state is not None:
                        rows.append(ended())
                    state = [w["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for k, (role, text) in enumerate(parse_window(w["text"])):
                    if k >= w["first_new"] or (k == 0 and w["system_new"]):
                        state[1] += 1
                        state[2].update(f"{role}\n{text}\n".encode())
                for a, b in zip(w["loss_starts"], w["loss_ends"]):
                    span = unescape(w["text"][a:b])
                    state[3] += len(span)
                    state[4].update(span.encode())
                state[5] += len(w["text"])
                state[6] += 1
        if state is not None:
            rows.append(ended())
        cols = list(zip(*rows)) if rows else [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                         names=[c.split()[0] for c in _REPORT.split(", ")])
    return windows.mapInArrow(run, _REPORT)
