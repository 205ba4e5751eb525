"""Conversation structure repair: the cheapest edits that make turns alternate.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles. Faulty rows
(blank, repeated, truncated) cost more to keep or must go; the edits are Keep,
Rerole, Delete and Insert. For every feasible length of the alternating grammar
string, with and without a system turn, the rows are aligned to that string
(Wagner-Fischer on suffix costs), within the Ukkonen band that the cheapest cost so
far leaves; lengths whose difference alone costs more are skipped. The backtrace
takes the ASCII-least edit wherever several are cheapest, and equal costs compare
their whole audits. Conversations over ``LONG`` rows use the grammar's four states
instead of its lengths (the same costs and audits, in time linear in their rows).

Rows are judged in Spark first; a repeat is a row number over (conversation, role,
text digest). Then one sorted stream for each task holds every conversation twice:
its rows' one-byte codes, from which the audit is found, and after them its texts,
which pass through the digest of the repaired conversation one by one. So a task
holds a few bytes for each row of the conversation at hand (the audit has one
letter for each), and never its texts, however long the conversation is.

Defined results: null role and text read as one space, a null conv_id is a
conversation, null turns come first and leave gaps alone; rows of equal turn are
ordered by role, then by text digest, so repeated rows stand side by side and all
but the first are duplicates; a conversation without rows after damage has zeros,
an empty audit and the digest of the empty string; other columns are not read;
empty tables give an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = 128  # rows; longer conversations are aligned to the grammar's states
WHITE = " \t\n\x0b\x0c\r"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, n_rows long")

# A row's code: its role's initial (0 other, 1 s, 2 u, 3 a) times 4, plus its fault.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
_INITIALS = {"s": 1, "u": 2, "a": 3}
_DELETE, _INSERT, _REROLE = 3, 2, 2
_NEVER = 1 << 60


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) damaged by crc32(``conv_id:turn``) % 20: 0 drops the
    row, 1 empties its text, 2 removes its end marks, 3 repeats it, 4 makes it user's."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    changed = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
               .otherwise(F.col("text")))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       changed.alias("text"), times.alias("again")).drop("again")


# -- alignment ---------------------------------------------------------------

def _substitute(code: int, symbol: int) -> int:
    """Cost of making a row the grammar's symbol (1 s, 2 u, 3 a): kept or given the role."""
    initial, fault = code >> 2, code & 3
    if fault in (BLANK, DUPLICATE):
        return _NEVER
    cost = 0 if initial == symbol else _REROLE if symbol > 1 else _NEVER
    return cost + (fault == TRUNCATED)


def _align(codes: bytes, target: bytes, limit: int) -> tuple[int, str] | None:
    """Least cost, at most ``limit``, and ASCII-least audit of turning the rows into ``target``."""
    n, m = len(codes), len(target)

    def apart(rows: int) -> int:  # least cost of so many more rows than symbols
        return _DELETE * rows if rows > 0 else -_INSERT * rows
    band = [o for o in range(-limit // _INSERT - 1, limit // _DELETE + 2) if apart(o) + apart(n - m - o) <= limit]
    if not band:
        return None
    low, high = band[0], band[-1]
    width = high - low + 3  # a border on both sides
    cost = [[_NEVER] * width for _ in range(n + 2)]  # [row][offset]: row minus symbol, by suffix
    for i in range(n, -1, -1):
        here, below = cost[i], cost[i + 1]
        for o in range(low, high + 1):  # more symbols left first: the offset falls as symbols are inserted
            j = i - o
            if not 0 <= j <= m:
                continue
            k = o - low + 1
            best = 0 if i == n and j == m else _NEVER
            if i < n:
                best = min(best, below[k + 1] + _DELETE)
                if j < m:
                    best = min(best, below[k] + _substitute(codes[i], target[j]))
            if j < m and target[j] > 1:
                best = min(best, here[k - 1] + _INSERT)
            here[k] = best
    total = cost[0][1 - low] if low <= 0 <= high else _NEVER
    if total > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:
        k = i - j - low + 1
        now = cost[i][k]
        if i < n and cost[i + 1][k + 1] + _DELETE == now:
            audit.append("D")
            i += 1
        elif j < m and target[j] > 1 and cost[i][k - 1] + _INSERT == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if codes[i] >> 2 == target[j] else "R")
            i, j = i + 1, j + 1
    return total, "".join(audit)


def _by_length(codes: bytes) -> tuple[int, str]:
    """The cheapest alignment over all feasible target lengths."""
    n = len(codes)
    cost, audit = _DELETE * n, "D" * n  # the empty conversation
    system = any(c >> 2 == 1 and _substitute(c, 1) < _NEVER for c in codes)
    usable = sum(c & 3 not in (BLANK, DUPLICATE) for c in codes)
    targets = [b"\x02\x03" * k for k in range(1, n + 2)]
    targets += [b"\x01" + t for t in targets] if system else []
    for target in sorted(targets, key=lambda t: (abs(len(t) - usable), t)):
        if (found := _align(codes, target, cost)) is not None and found < (cost, audit):
            cost, audit = found
    return cost, audit


def _by_state(codes: bytes) -> tuple[int, str]:
    """The same for a conversation of any length: 0 nothing yet, after 1 s, 2 u, 3 a."""
    following = ((1, 2), (2,), (3,), (2,))  # symbols that may follow each state; each leads to the state of its number

    def inserted(c: list[int]) -> list[int]:
        for _ in range(2):
            c = [min(c[0], c[2] + _INSERT), min(c[1], c[2] + _INSERT), min(c[2], c[3] + _INSERT), min(c[3], c[2] + _INSERT)]
        return c
    costs = [inserted([0, _NEVER, _NEVER, 0])]
    for code in reversed(codes):
        after = costs[-1]
        costs.append(inserted([min(after[q] + _DELETE, *(after[s] + _substitute(code, s) for s in following[q]))
                               for q in range(4)]))
    costs.reverse()
    audit, i, q = [], 0, 0
    while i < len(codes) or q in (1, 2):
        now, least = costs[i][q], 3 if q == 2 else 2
        if i < len(codes) and costs[i + 1][q] + _DELETE == now:
            audit.append("D")
            i += 1
        elif costs[i][least] + _INSERT == now:
            audit.append("I")
            q = least
        else:
            code = codes[i]
            kept = code >> 2
            fits = kept in following[q] and costs[i + 1][kept] + _substitute(code, kept) == now
            audit.append("K" if fits else "R")
            i, q = i + 1, kept if fits else least
    return costs[0][0], "".join(audit)


@functools.lru_cache(maxsize=1 << 16)
def _remembered(codes: bytes) -> tuple[int, str]:
    return _by_length(codes)


def cheapest(codes: bytes, long: int = LONG) -> tuple[int, str]:
    """(cost, audit) of a conversation given by its rows' codes."""
    return _by_state(codes) if len(codes) > long else _remembered(codes) if len(codes) <= 16 else _by_length(codes)


# -- streams -----------------------------------------------------------------

class _Conversation:
    """One conversation as its rows pass: codes first, then texts in the same order."""

    def __init__(self, conv_id, long: int):
        self.conv_id, self.long = conv_id, long
        self.codes = bytearray()
        self.first = self.last = None  # turns
        self.turns = 0
        self.plan: tuple[int, str] | None = None

    def code(self, turn, code: int) -> None:
        self.codes.append(code)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1

    def start(self) -> None:
        if self.plan is None:
            self.plan = cheapest(bytes(self.codes), self.long)
            self.at, self.state, self.lines, self.sha = 0, 0, 0, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.lines else "").encode() + f"{role}:".encode("utf-8", "surrogatepass")
                        + text.encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _given(self, text: str) -> None:
        self.state = 3 if self.state == 2 else 2
        self._line("assistant" if self.state == 3 else "user", text)

    def _inserts(self) -> None:
        audit = self.plan[1]
        while self.at < len(audit) and audit[self.at] == "I":
            self._given("")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        self.start()
        self._inserts()
        edit = self.plan[1][self.at]
        self.at += 1
        if edit == "K":
            self.state = _INITIALS[role[:1]]
            self._line(role, text)
        elif edit == "R":
            self._given(text)

    def result(self) -> tuple:
        self.start()
        self._inserts()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        faults = [c & 3 for c in self.codes]
        legal = {(1, 2), (2, 3), (3, 2)}
        initials = [c >> 2 for c in self.codes]
        illegal = sum(pair not in legal for pair in zip(initials, initials[1:]))
        return (self.conv_id, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal,
                *self.plan, self.sha.hexdigest(), len(self.codes))


def _streamed(long: int):
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
            return out
        for batch in batches:
            for conv_id, turn, role, code, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv_id, long)
                if text is not None:
                    now.text(role, text)
                elif code is not None:
                    now.code(turn, code)
            if len(done) >= 1000:
                yield passed_on()
        if now is not None:
            done.append(now.result())
        if done:
            yield passed_on()
    return run


def repair(rows: DataFrame, conversations: DataFrame, long: int = LONG) -> DataFrame:
    """One row for each conv_id of ``conversations``: the faults of its ``rows``
    (conv_id, turn, role, text; no nulls in role and text), the cheapest edits that
    repair it, and the digest of the repaired conversation."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = rows.select("conv_id", "turn", "role", "text", digest.alias("digest"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())) > 1
    initial = F.left("role", F.lit(1))
    place = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    judged = rows.select("conv_id", "turn", "role", "digest", (end == "").alias("blank"),
                         (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"), place.alias("place"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("seen"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    codes = judged.withColumn("seen", seen).select(
        "conv_id", "turn", "role", (F.col("place") * 4 + fault).alias("code"), F.lit(None).cast("string").alias("text"),
        F.lit(0).alias("pass"), "digest", F.col("seen").cast("int").alias("again"))
    texts = rows.select("conv_id", "turn", "role", F.lit(None).cast("int").alias("code"), "text", F.lit(1).alias("pass"), "digest",
                        F.lit(0).alias("again"))
    null = {c.name: F.lit(None).cast(c.dataType).alias(c.name) for c in codes.schema}
    marks = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(
        "conv_id", *(F.lit(-1).alias(c) if c == "pass" else null[c] for c in codes.columns[1:]))
    stream = codes.unionByName(texts).unionByName(marks).repartition("conv_id").sortWithinPartitions(
        "conv_id", "pass", F.col("turn").asc_nulls_first(), "role", "digest", "again")
    return stream.select("conv_id", "turn", "role", "code", "text").mapInArrow(_streamed(long), RESULT)
