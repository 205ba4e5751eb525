import os
import random
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import toxicity as T  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def _corpus(seed, docs=600):
    """Invented insults (stem + random ending), unknown to the fixed lexicon."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(docs):
        ws = ["".join(r.choices("aeioulmnrst", k=r.randint(2, 7))) for _ in range(r.randint(5, 200))]
        toxic = r.random() < 0.15
        for _ in range(r.randint(1, 4) if toxic else 0):
            ws.insert(r.randrange(len(ws) + 1), r.choice(["zworga", "kvaxil", "gruupf"]) + "".join(r.choices("aeiou", k=2)))
        rows.append((i, " ".join(ws)))
        if r.random() < 0.6:
            labels.append((i, 0, int(toxic)))
        rows[-1] += (toxic,)
    return rows, labels


def test_held_out_quality_on_invented_words(spark):
    rows, labels = _corpus(1)
    docs = documents(spark, [r[:2] for r in rows])
    got = {r.doc_id: r for r in T.score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(rows)
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    out = [(got[i].predicted, t) for i, _, t in rows if got[i].held_out]
    caught = sum(p for p, t in out if t) / sum(t for _, t in out)
    false = sum(p for p, t in out if not t)
    assert caught >= 0.95 and false == 0


def test_held_out_labels_do_not_matter(spark):
    rows, labels = _corpus(2, 200)
    docs = documents(spark, [r[:2] for r in rows])
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in T.score_documents(docs, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped))
    assert a == b


def test_hand_made_cases(spark):
    rows = [(1, None), (2, ""), (3, "you stupid pathetic moron, worthless scum"), (4, "a quiet walk by the lake"), (None, "idiot idiot moron loser"),
            (5, "lake " * 100_000), (3, "you stupid pathetic moron, worthless scum")]
    docs = documents(spark, rows).withColumn("toxic", F.lit(1)).withColumn("score", F.lit(1.0)).withColumn("label", F.lit(1))
    for labels in ([], [(1, None, None), (None, 1, 1), (99, 0, 1), (4, 0, 0), (4, 0, 0)]):
        got = T.score_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        by = {}
        for r in got:
            by.setdefault(r.doc_id, r.score)
        assert by[1] == by[2] and not next(r for r in got if r.doc_id is None).held_out
    kept = T.drop_toxic(docs, spark.createDataFrame([], LABELS))
    assert kept.columns == docs.columns and {1, 2, 4, 5} <= {r.doc_id for r in kept.collect()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert T.score_documents(none, spark.createDataFrame([(1, 0, 1)], LABELS)).count() == 0


def test_label_model_recovers_rates_and_discounts_copies(spark):
    """Generated votes: rates come back, and of two equal voters each counts half."""
    r = np.random.default_rng(4)
    y = r.random(20_000) < 0.2
    votes = np.stack([np.where(y, r.random(20_000) < a, r.random(20_000) < b) for a, b in ((0.7, 0.02), (0.5, 0.01), (0.6, 0.03))], 1)
    votes = np.concatenate([votes, votes[:, :1]], 1)
    patterns = {}
    for v, t, known in zip(votes, y, r.random(20_000) < 0.05):
        row = patterns.setdefault(np.flatnonzero(v).astype(np.uint16).tobytes(), [0, 0, 0])
        row[0 if not known else 1 if t else 2] += 1
    df = spark.createDataFrame([(bytearray(k), *v) for k, v in patterns.items()], "pattern binary, n long, pos long, neg long")
    model = T.fit_label_model(df, 4, 0)
    assert abs(model.prior - 0.2) < 0.03 and np.allclose(model.a[:4], [0.7, 0.5, 0.6, 0.7], atol=0.08)
    assert model.weight[0] < 0.65 and model.weight[3] < 0.65 and model.weight[1] > 0.8


def test_every_labelled_row_calibrates_however_few_are_sampled(spark, monkeypatch):
    """Few classifier rows among many unlabelled documents; posteriors of exactly 0 or 1 are no labels."""
    seen = []
    calibrated, train = T._calibrated, T._train
    monkeypatch.setattr(T, "_calibrated", lambda known, *a: seen.append(known) or calibrated(known, *a))
    monkeypatch.setattr(T, "_train", lambda rows, *a: seen.append(rows) or train(rows, *a))
    rows, labels = _corpus(3, 2000)
    labels = labels[:400]
    docs = documents(spark, [r[:2] for r in rows])
    assert T.score_documents(docs, spark.createDataFrame(labels, LABELS), max_rows=120).count() == len(rows)
    used = [t for i, _, t in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    trained, known = seen
    assert sorted(k[0] for k in known) == sorted(float(t) for t in used)
    assert sum(r[0] == 0.0 for r in trained) >= 20 and sum(r[0] == 1.0 for r in trained) >= 20 and len(trained) <= 180
