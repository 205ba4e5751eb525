"""Benchmark decontamination with SimHash windows.

Every benchmark item of L words is compared with the document's windows of L
words. Items and windows are bags of 5-word shingles (items of fewer words: one
shingle, the whole item); their similarity is sum(min counts) / sum(max counts),
and a document and an item match when some window reaches ``threshold``. A
document of fewer than L words is one window as a whole (of fewer words than a
shingle has, it shares none with the item).

A 128-bit SimHash stands for each window and item. Candidate items come from a
multi-index over its 16 bytes: fingerprints within 48 bits agree to 3 bits in one
byte at least, so looking up each byte's 3-bit neighbourhood finds every
fingerprint in the radius (a similarity of 0.8 has an expected distance of 19
bits, standard deviation 4). Candidates within the radius are verified exactly.
A window is fingerprinted only if enough of its shingles occur in items of its
length: the others cannot reach the threshold.

The items are a stated query set, read in blocks of about ``block_bytes``; each
block is one pass over the documents without a shuffle.

Defined results: null or empty texts and items without words match nothing;
repeated documents and items give repeated rows; of equally similar windows the
first counts; null ids stay null; other columns are not read; empty tables give
an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze.llm.common import share, words
from haze.llm.ngram_join import _C1, _C2, _U, mix, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
BITS, RADIUS = 128, 48  # 16 bytes, so 48 // 16 = 3 bits in some byte
BLOCK_BYTES = 1 << 20
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_FOUND = "doc_id long, item_id long, similarity double, start long, words long"


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles in order, repeats included."""
    acc = np.full(len(h) - n + 1, n, _U)
    for j in range(n):
        acc = acc * _C1 + h[j:len(h) - n + 1 + j]
    return mix(acc)


def _bits(g: np.ndarray) -> np.ndarray:
    """128 bits of each shingle hash, one byte each."""
    both = np.stack([g, mix(g + _C2)], axis=1)
    return np.unpackbits(both.view(np.uint8).reshape(len(g), 16), axis=1)


def simhash(g: np.ndarray) -> np.ndarray:
    """16 bytes: the majority of each bit over the bag of shingles."""
    return np.packbits(2 * _bits(g).sum(axis=0, dtype=np.int64) > len(g))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def _bag(ws: list[bytes], n: int) -> Counter:
    return Counter(zip(*(ws[i:] for i in range(n))))


class Matcher:
    """Index of one block of items: (item_id, text) pairs."""

    def __init__(self, items: list[tuple], threshold: float = THRESHOLD):
        self.threshold = threshold
        groups = defaultdict(list)
        grams = defaultdict(list)  # shingle width -> hashes
        self.lengths: dict = defaultdict(dict)  # shingle width -> hash -> lengths of the items that have it
        with np.errstate(over="ignore"):
            for item_id, text in items:
                ws = words(text)
                if ws:
                    n = min(SHINGLE, len(ws))
                    g = rolling(word_hashes(ws), n)
                    groups[len(ws)].append((item_id, _bag(ws, n), simhash(g)))
                    grams[n].append(g)
                    for x in set(g.tolist()):
                        self.lengths[n].setdefault(x, set()).add(len(ws))
        self.grams = {n: np.unique(np.concatenate(g)) for n, g in grams.items()}
        self.filters = {}
        for n, g in self.grams.items():  # a bitmap of at least 64 places a shingle comes before the exact lookup
            size = 1 << max(16, int(len(g) * 64 - 1).bit_length())
            self.filters[n] = np.zeros(size, bool)
            self.filters[n][(g & _U(size - 1)).astype(np.int64)] = True
        self.groups = {}
        for length, rows in groups.items():
            prints = np.stack([r[2] for r in rows])
            near = _POPCOUNT[np.arange(256, dtype=np.uint8)[:, None, None] ^ prints[None]] <= RADIUS // 16
            self.groups[length] = ([r[0] for r in rows], [r[1] for r in rows], prints,
                                   np.ascontiguousarray(near.transpose(2, 0, 1)))  # byte, value, item

    def _known(self, g: np.ndarray, n: int) -> np.ndarray:
        may = self.filters[n][(g & _U(len(self.filters[n]) - 1)).astype(np.int64)]
        at = np.flatnonzero(may)
        if len(at):
            all_grams = self.grams[n]
            where = np.minimum(np.searchsorted(all_grams, g[at]), len(all_grams) - 1)
            may[at] = all_grams[where] == g[at]
        return may

    def find(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Index of the item in the block -> (similarity, first word, words) of its best window."""
        ws = words(text)
        found: dict = {}
        if not ws or not self.groups:
            return found
        with np.errstate(over="ignore"):
            h = word_hashes(ws)
            for n in self.grams:
                if len(ws) < n:
                    continue
                g = rolling(h, n)
                known = np.flatnonzero(self._known(g, n))
                places = defaultdict(list)  # item length -> places of its items' shingles
                for at, x in zip(known.tolist(), g[known].tolist()):
                    for length in self.lengths[n][x]:
                        places[length].append(at)
                for length, at in places.items():
                    size = length - n + 1
                    if len(ws) < length:  # the whole document is the window; the similarity is at most hits / size
                        if len(at) >= self.threshold * size - 1e-9:
                            self._verify(g, ws, 0, length, n, found)
                        continue
                    before = np.zeros(len(g) + 1, np.int64)
                    before[np.array(at) + 1] = 1
                    before = np.cumsum(before)
                    hits = before[size:] - before[:-size]  # of each window's shingles, those that items of its length have
                    for start in np.flatnonzero(hits >= self.threshold * size - 1e-9).tolist():
                        self._verify(g, ws, start, length, n, found)
        return {(self.groups[length][0][k], length, k): v for (length, k), v in found.items()}

    def _verify(self, g, ws, start, length, n, found) -> None:
        """Candidates of one window by the multi-index, then exactly."""
        _, bags, prints, near = self.groups[length]
        fp = simhash(g[start:start + length - n + 1])
        cand = np.flatnonzero(near[np.arange(16), fp].any(axis=0))
        cand = cand[_POPCOUNT[prints[cand] ^ fp].sum(axis=1) <= RADIUS]
        if not len(cand):
            return
        bag = _bag(ws[start:start + length], n)
        for k in cand.tolist():
            sim = similarity(bag, bags[k])
            if sim >= self.threshold - 1e-12 and sim > found.get((length, k), (0.0,))[0]:
                found[length, k] = (sim, start, min(length, len(ws)))


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for b in range(blocks):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()]


def find_contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, similarity, start, words): each matching pair with its best window."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], _FOUND)
    for block in _blocks(items, "item_id", "text", block_bytes):
        shared = share(spark, Matcher(block, threshold))  # bounded by block_bytes

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(i, key[0], *best) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        for key, best in shared().find(t).items()]
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "similarity", "start", "words"])
        out = out.union(plain.mapInArrow(run, _FOUND))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that match an item; same columns, no shuffle."""
    text_at = docs.columns.index("text")
    for block in _blocks(items, "item_id", "text", block_bytes):
        shared = share(docs.sparkSession, Matcher(block, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not shared().find(t) for t in batch.column(text_at).to_pylist()], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
