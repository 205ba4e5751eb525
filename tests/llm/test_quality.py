import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from haze.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"


def _corpus(seed, n=700):
    rng = random.Random(seed)
    stems = ["ba", "lo", "mi", "ren", "tu", "sha", "kel", "or"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(stems) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        bad = rng.random() < 0.3
        kind = rng.randrange(3)
        if bad and kind == 0:
            words = [w + rng.choice(["$$$", "***", "%%%"]) for w in words]
        elif bad and kind == 1:
            words = [w.upper() + "!!" for w in words]
        elif bad:
            words = [w for w in words for _ in range(12)]
        else:
            words = [w.capitalize() if j % 9 == 0 else w + "." if j % 9 == 8 else w for j, w in enumerate(words)]
        rows.append((i, " ".join(words), "en", "low" if bad else "s"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def _held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    rows, labels = _corpus(1)
    out = Q.score_documents(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), shard_rows=150)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    truth = {i: q for i, q, _ in labels}
    got = out.collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and {r.doc_id for r in held} == {i for i in truth if _held(i)}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_change_nothing(spark):
    rows, labels = _corpus(2, 200)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, 1 - q if _held(i) else q, t) for i, q, t in labels]
    a, b = (Q.fit(docs, spark.createDataFrame(part, LABELS), dimensions=1 << 12, rounds=2) for part in (labels, turned))
    assert np.array_equal(a, b)


def test_updates_follow_the_regularised_leader():
    """Against the closed form: each weight minimises its summed gradients and squares plus penalties."""
    rng = np.random.default_rng(3)
    leader = Q.Leader(np.zeros(8), np.zeros(8))
    linear, squares, steps = np.zeros(8), np.zeros(8), np.zeros(8)
    for _ in range(40):
        idx = np.sort(rng.choice(8, 4, replace=False)).astype(np.int32)
        value, label = rng.random(4).astype(np.float32), float(rng.integers(2))
        w = leader.weights()
        g = (1 / (1 + np.exp(-float(w[idx] @ value))) - label) * value
        rate = np.sqrt(squares[idx] + g * g) / Q.ALPHA - np.sqrt(squares[idx]) / Q.ALPHA
        linear[idx] += g - rate * w[idx]
        squares[idx] += g * g
        steps[idx] += rate
        leader.learn(idx, value, label)
    def cost(j, x):  # noqa: E306
        return linear[j] * x + 0.5 * (steps[j] + Q.BETA / Q.ALPHA + Q.L2) * x * x + Q.L1 * abs(x)
    for j, x in enumerate(leader.weights()):
        assert all(cost(j, x) <= cost(j, x + d) + 1e-12 for d in (-0.01, -1e-4, 1e-4, 0.01))


def test_vectors_cover_the_whole_text():
    words = Q._Words()
    idx, value = Q.vector(words, "One two two. " * 50_000 + "END!!")
    assert len(set(idx.tolist())) == len(idx)
    assert abs(float((value.astype(float) ** 2).sum()) - 6) < 1e-3  # the bias and five kinds of length 1
    assert len(idx) > len(Q.vector(words, "One two two. " * 50_000)[0])
    assert Q.vector(words, None)[0].tolist() == Q.vector(words, " \n")[0].tolist() == [0]


def test_hand_made_cases(spark):
    rows = [(1, None, "a", "s"), (2, "", None, "s"), (3, "x y", "a", None), (3, "x y", "a", "s"), (None, "n", "b", "s"), (5, "w " * 100_000, "b", "s")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.lit("z")).withColumn("score", F.lit(0.1))
    labels = spark.createDataFrame([(3, 1, None), (3, 0, 1), (5, None, None), (None, 1, 1), (77, 0, 0)], LABELS)
    got = Q.score_documents(docs, labels).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    none = Q.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert Q.score_documents(docs.limit(0), labels).count() == 0
