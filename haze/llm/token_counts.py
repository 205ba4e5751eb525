"""Token counts by a linear longest-match automaton.

Greedy word pieces: at each place of a word the longest piece that fits, pieces
at the word's start from one set and pieces inside it from another. The automaton
is a trie of both sets. Where no edge goes on from a node, its failure link leads
to the node of what is left after the pieces that greedy matching would have
taken; how many those are is stored with the node. One step per byte and pop gives
the number of pieces of a word in linear time, without building one.

The vocabulary comes from a byte-level tokenizer file (a parameter): its tokens
with a leading space start words, the others go inside; every single byte is a
piece of both sets, so no word is unknown. The driver builds the automaton
(bounded by the vocabulary) and ships it.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: null and empty texts count 0;
repeated rows give repeated rows; null ids stay null; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze.llm.common import share

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
_CACHED_WORDS, _CACHED_BYTES = 500_000, 48


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str = VOCABULARY) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start a word, pieces inside a word) of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    alphabet = byte_alphabet()
    first, inner = set(), set()
    for token in tokens:
        if all(c in alphabet for c in token):
            raw = bytes(alphabet[c] for c in token)
            if raw[:1] == b" ":
                first.add(raw[1:])
            else:
                inner.add(raw)
    return first - {b""}, inner


class Automaton:
    FIRST, INNER = 0, 1  # the roots

    def __init__(self, first: Iterable[bytes], inner: Iterable[bytes]):
        single = {bytes([b]) for b in range(256)}
        self.edges: dict[int, int] = {}  # node * 256 + byte -> node
        ends, nodes = set(), 2
        for root, pieces in ((self.FIRST, set(first) | single), (self.INNER, set(inner) | single)):
            for piece in pieces:
                node = root
                for b in piece:
                    nxt = self.edges.get(node << 8 | b)
                    if nxt is None:
                        nxt = self.edges[node << 8 | b] = nodes
                        nodes += 1
                    node = nxt
                ends.add(node)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.edges.items():
            children.setdefault(key >> 8, []).append((key & 255, node))
        self.fail: list[int | None] = [None] * nodes
        self.popped = [0] * nodes
        queue = deque([self.FIRST, self.INNER])
        while queue:  # by depth: a failure link leads to a node that is done
            node = queue.popleft()
            for b, child in children.get(node, ()):
                queue.append(child)
                if child in ends:
                    self.fail[child], self.popped[child] = self.INNER, 1
                    continue
                pops, z = self.popped[node], self.fail[node]
                while z is not None and (z << 8 | b) not in self.edges:
                    pops, z = pops + self.popped[z], self.fail[z]
                if z is not None:
                    self.fail[child], self.popped[child] = self.edges[z << 8 | b], pops

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of one word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, pieces = self.FIRST, 0
        for b in word:
            nxt = edges.get(node << 8 | b)
            while nxt is None:
                pieces += popped[node]
                node = fail[node]
                nxt = edges.get(node << 8 | b)
            node = nxt
        while node > self.INNER:
            pieces += popped[node]
            node = fail[node]
        return pieces


class _Counts(dict):
    """Word -> pieces; emptied when full, long words are not kept."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word)
        if len(word) <= _CACHED_BYTES:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row, over its whole text."""
    shared = share(docs.sparkSession, Automaton(*read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared())
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                ws = text.encode().split() if text else []
                n_words.append(len(ws))
                n_tokens.append(sum(map(counts.__getitem__, ws)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_tokens long"))
