"""Quality classifier: logistic regression on hashed word n-grams.

A text's n-grams are its words and word pairs, and runs of one to three word forms
(case, ending, and whether the word repeats the one before). Each n-gram is hashed
into one of ``dimensions`` weights; its value is the square root of its share of the
text's n-grams of that kind, so every text has the same length as a vector. The
score of a text is the logistic function of a sparse dot product.

Weights are fitted by follow-the-regularised-leader updates (one step size for each
weight, L1 and L2 penalties). The sample is cut into shards of ``shard_rows`` rows by
a hash; in each round every shard goes on from the common state in a task of its
own, and the shards' changes are averaged in Spark.

Bounds (parameters): ``max_labelled`` labelled rows are fitted on, chosen by a hash
of the id; the driver sees ``dimensions`` weights and no texts. Only labels of rows
that are not held out are used. Labels, lang, source and doc_id are never inputs of
a score. All other work covers every document and whole texts.

Defined results: null and empty texts get the score of the bias alone; null labels
and labels of unknown documents are not used; several labels of a document count as
low quality if one is low; without labels every score is 0.5; repeated rows give
repeated rows; other columns are not read; empty tables give an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze.llm.common import share, written
from haze.llm.toxicity import held_out

MAX_LABELLED, DIMENSIONS, ROUNDS, SHARD_ROWS = 16_000, 1 << 18, 4, 2_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
THRESHOLD = 0.5
# Sixteenths of the weights for words, word pairs, forms, form pairs and form triples.
_RANGES = (4, 7, 1, 2, 2)


class _Words(dict):
    """Word -> 32-bit hash of its lower-cased letters and digits, and its form in the
    lowest 6 bits. Emptied when full."""

    SIZE = 300_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.SIZE:
            self.clear()
        plain = "".join(filter(str.isalnum, word))
        if not plain:
            case = 0
        elif plain.isdigit():
            case = 1
        else:
            case = 2 if plain.islower() else 3 if plain.isupper() and len(plain) > 1 else 4 if plain.istitle() else 5
        last = word[-1]
        ending = (0 if last.isalnum() else 1 if word[-2:-1].isalnum() and last in ".!?" else 2 if word[-2:-1].isalnum() and last in ",;:)"
                  else 3)
        out = self[word] = zlib.crc32((plain or word).lower().encode("utf-8", "surrogatepass")) << 6 | case << 2 | ending
        return out

    def __reduce__(self):  # travels empty
        return _Words, ()


def _hashed(grams: np.ndarray, kind: int, dimensions: int) -> np.ndarray:
    """Indices in the kind's own range, so that no index of a text comes twice; 0 is the bias."""
    h = grams * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    first, size = sum(_RANGES[:kind]) * dimensions // 16, _RANGES[kind] * dimensions // 16
    return ((h >> np.uint64(32)) % np.uint64(size - 1) + np.uint64(first + 1)).astype(np.int32)


def vector(words: _Words, text: str | None, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a whole text; index 0 is the bias."""
    codes = np.array([words[w] for w in text.split()] if text else [], np.uint64)
    if not len(codes):
        return np.zeros(1, np.int32), np.ones(1, np.float32)
    word = codes >> np.uint64(6)
    form = (codes & np.uint64(63)) << np.uint64(1)
    form[1:] |= (word[1:] == word[:-1]).astype(np.uint64)
    by = np.uint64(0x100000001B3)
    pairs, forms2 = word[:-1] * by + word[1:], (form[:-1] << np.uint64(8)) | form[1:]
    idx, value = [np.zeros(1, np.int32)], [np.ones(1, np.float32)]
    for kind, grams in enumerate((word, pairs, form, forms2, (forms2[:-1] << np.uint64(8)) | form[2:])):
        if len(grams):
            found, n = np.unique(_hashed(grams, kind, dimensions), return_counts=True)
            idx.append(found)
            value.append(np.sqrt(n / len(grams)).astype(np.float32))
    return np.concatenate(idx), np.concatenate(value)


class Leader:
    """Follow-the-regularised-leader state: gradient sums z and squared sums n."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, idx: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(idx)
        g = (_logistic(float(w @ value)) - label) * value
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[idx] = n + g * g


def _logistic(z: float) -> float:
    return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))


def _sample(docs: DataFrame, labels: DataFrame, max_labelled: int, dimensions: int, shard_rows: int) -> tuple[DataFrame, int]:
    """((shard, place, label, idx, value) of the labelled sample, shards)."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
             .filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label")))
    known = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "quality-labels")
    shards = max(1, -(-known.count() // shard_rows))
    rows = docs.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")  # at most max_labelled ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            found = [vector(words, t, dimensions) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([i.tobytes() for i, _ in found], pa.binary()),
                 pa.array([v.tobytes() for _, v in found], pa.binary())], names=["doc_id", "label", "idx", "value"])
    place = F.xxhash64(F.lit(13), "doc_id")
    vectors = rows.mapInArrow(run, "doc_id long, label int, idx binary, value binary").select(
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.xxhash64(F.lit(31), "doc_id").alias("place"), "label", "idx", "value")
    return written(vectors, "quality-sample"), shards


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, dimensions: int = DIMENSIONS,
        rounds: int = ROUNDS, shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """The weights. docs: (doc_id, text)."""
    sample, shards = _sample(docs, labels, max_labelled, dimensions, shard_rows)
    z, n = np.zeros(dimensions), np.zeros(dimensions)
    for _ in range(rounds):
        state = share(docs.sparkSession, (z, n))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def moved(leader: Leader) -> pa.RecordBatch:
                z0, n0 = state()
                at = np.flatnonzero(leader.n != n0)
                return pa.RecordBatch.from_arrays([pa.array(at), pa.array(leader.z[at] - z0[at]), pa.array(leader.n[at] - n0[at])],
                                                  names=["i", "z", "n"])
            shard = leader = None
            for batch in batches:
                for at, label, idx, value in zip(*(batch.column(k).to_pylist() for k in range(4))):
                    if at != shard:
                        if leader is not None:
                            yield moved(leader)
                        shard, leader = at, Leader(*(a.copy() for a in state()))
                    leader.learn(np.frombuffer(idx, np.int32), np.frombuffer(value, np.float32), float(label))
            if leader is not None:
                yield moved(leader)
        steps = (sample.repartition(shards, "shard").sortWithinPartitions("shard", "place", "idx", "value")
                 .select("shard", "label", "idx", "value").mapInArrow(run, "i long, z double, n double"))
        at, dz, dn = _columns(steps.groupBy("i").agg((F.sum("z") / shards).alias("z"), (F.sum("n") / shards).alias("n")))
        z, n = z.copy(), n.copy()
        z[at] += dz
        n[at] += dn
    return Leader(z, n).weights()


def _columns(moves: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``dimensions`` rows (i, z, n)."""
    rows = moves.toPandas()
    return rows.i.to_numpy(np.int64), rows.z.to_numpy(float), rows.n.to_numpy(float)


def score_documents(docs: DataFrame, labels: DataFrame, dimensions: int = DIMENSIONS, **bounds) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = share(docs.sparkSession, fit(docs, labels, dimensions=dimensions, **bounds).astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, w = _Words(), weights()
        for batch in batches:
            found = (vector(words, t, dimensions) for t in batch.column(1).to_pylist())
            score = [_logistic(float(w[idx] @ value)) for idx, value in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])
    return docs.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
