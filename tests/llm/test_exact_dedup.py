import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import exact_dedup as X  # noqa: E402


def _low(t):
    return (t or "").encode().lower().decode()  # bytes.lower touches A-Z only


def _brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(_low(t), []).append(i)
    out = []
    for i, t in rows:
        g = groups[_low(t)]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(_low(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "Aa b"), (2, "aA B"), (3, None), (4, ""), (5, "É x"), (6, "é x"), (9, "AA B"), (7, "z" * 300_000),
        (8, "Z" * 300_000), (10, "solo"), (None, "solo"), (None, "lonely"), (11, " aa b")]


def test_report_matches_brute_force(spark):
    got = X.dedup_report(documents(spark, ROWS))
    assert sorted(map(tuple, got.collect()), key=str) == _brute(ROWS)


def test_repeated_rows_and_ties(spark):
    rows = [(1, "x"), (1, "x"), (2, "y"), (2, "Y"), (0, "y")]
    docs = documents(spark, rows)
    assert sorted(map(tuple, X.dedup_report(docs).collect()), key=str) == _brute(rows)
    left = [(r.doc_id, _low(r.text)) for r in X.deduplicate(docs).collect()]
    assert sorted(left) == [(1, "x"), (2, "y")]


def test_deduplicate_keeps_columns_and_clashing_names(spark):
    docs = documents(spark, [r for r in ROWS if len(r[1] or "") < 99])
    docs = docs.withColumn("digest", F.lit(1)).withColumn("keep_id", F.lit(2)).withColumn("digest_", F.lit(3))
    left = X.deduplicate(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {4, 5, 6, 9, 10, None, 11}


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert X.dedup_report(docs).count() == 0 and X.deduplicate(docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 65, 5000])
def test_mph_is_minimal_and_perfect(n):
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), "<u8").reshape(-1, 4)
    levels = X.build_mph(keys)
    assert sorted(X.mph_slots(levels, keys)) == list(range(n))


def test_many_shards(spark):
    rows = [(i, f"t{i % 40}") for i in range(200)]
    keyed = X.keyed_rows(documents(spark, rows))
    groups = X.digest_groups(keyed.filter("id < 90"), keyed.filter("id >= 90"), shard_keys=7)
    got = {bytes(r.digest): (r.keep_id, r.n) for r in groups.collect()}
    assert got == {hashlib.sha256(f"t{k}".encode()).digest(): (160 + k, 5) for k in range(40)}


@pytest.mark.parametrize("low", [[0], [-1, 0], [None]])
def test_shards_are_sized_by_the_incoming_digests_too(spark, low, monkeypatch):
    """One low id, or none at all, leaves next to no history: every digest comes in."""
    lookup = X._lookup

    def bounded(incoming, index):
        assert len(incoming) <= 120, len(incoming)
        return lookup(incoming, index)
    monkeypatch.setattr(X, "_lookup", bounded)
    ids = [None] * 2000 if low == [None] else [10**12 + i for i in range(2000)]
    rows = [(i, f"t{k % 1500}") for k, i in enumerate(ids)] + [(i, "t3") for i in low]
    keyed, groups = X.exact_groups(documents(spark, rows), shard_keys=50)
    got = {bytes(r.digest).hex(): (r.keep_id, r.n) for r in groups.collect()}
    assert got == {d: (keep, n) for _, keep, n, _, d in _brute(rows)} and len(got) == 1500
