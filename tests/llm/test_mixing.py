import math
import os
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import mixing as M  # noqa: E402


def _rows(hot=400):
    rows = [(i, "w " * (1 + i % 7), "hot") for i in range(hot)]
    for s in range(5):
        rows += [(10_000 + 1000 * s + i, "v " * (1 + i % 5), f"s{s}") for i in range(6 * (s + 1))]
    return rows


def _exponent(totals, entropy, max_repeats, budget):
    """Plain bisection."""
    whole = sum(totals)
    p = [t / whole for t in totals]

    def weights(a):
        w = [x ** a for x in p]
        return [x / sum(w) for x in w]

    def bisect(lo, hi, met):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if met(mid) else (mid, hi)
        return hi

    def entropy_met(a):
        return -sum(x * math.log(x) for x in weights(a)) <= entropy * math.log(len(p))

    def repeats_met(a):
        w = weights(a)
        b = budget or max(t / x for t, x in zip(totals, w))
        return max(x * b / t for t, x in zip(totals, w)) <= max_repeats
    a = bisect(0, 64, entropy_met)
    return a if a >= 1 or repeats_met(a) else bisect(a, 1, repeats_met), weights


@pytest.mark.parametrize("entropy,repeats,budget", [(0.9, 100, None), (0.9, 100, "all"), (0.97, 2.5, "all"), (0.99, 3, None), (0.5, 9, 700)])
def test_plan_and_copies_match_brute_force(spark, entropy, repeats, budget):
    rows = _rows()
    docs = documents(spark, rows)
    out = M.mix_sources(docs, entropy, repeats, budget, block_docs=16)
    placed = {r.doc_id: r.pos for r in docs.select("doc_id", M.position(0, F.col("doc_id"), F.col("text")).alias("pos")).collect()}
    got = {r.doc_id: r for r in out.collect()}
    totals, members = defaultdict(int), defaultdict(list)
    for i, t, s in rows:
        totals[s] += len(t.split())
        members[s].append((placed[i], len(t.split()), i))
    names = sorted(totals)
    whole = sum(totals.values())
    b = whole if budget == "all" else budget
    a, weights = _exponent([totals[s] for s in names], entropy, repeats, b)
    for s, w in zip(names, weights(a)):
        t = totals[s]
        quota = w * (b or max(totals[x] / y for x, y in zip(names, weights(a))))
        assert all(abs(got[i].weight - w) < 1e-5 for _, _, i in members[s])
        drawn = sum(got[i].copies * n for _, n, i in members[s])
        longest = max(n for _, n, _ in members[s])
        assert quota - longest - 1e-2 <= drawn <= quota + 1e-2, (s, quota, drawn)  # whole rows up to the budget
        extra = [got[i].copies - min(got[j].copies for _, _, j in members[s]) for _, _, i in sorted(members[s])]
        assert extra == sorted(extra, reverse=True) and set(extra) <= {0, 1}  # the head of the permutation
    if b is None:
        assert min(r.copies for r in got.values()) >= 1 and max(r.copies for r in got.values()) <= repeats + 1


def test_hand_made_cases(spark):
    rows = [(1, None, "a"), (2, "", "empty"), (3, "x y", None), (3, "x y", None), (4, "word " * 100_000, "a"), (None, "n", "b"), (5, "q", "b")]
    docs = documents(spark, rows).withColumn("n_tokens", F.lit(7)).withColumn("copies", F.lit(8)).withColumn("plan_source", F.lit("z"))
    out = M.mix_sources(docs)
    assert out.columns == docs.columns + ["_n_tokens", "weight", "_copies"]
    got = out.collect()
    assert sorted(r._n_tokens for r in got) == [0, 0, 1, 1, 2, 2, 100_000]
    assert min(r._copies for r in got) >= 1 and next(r for r in got if r.source == "empty").weight == 0
    one = M.mix_sources(documents(spark, [(1, "a b", "s"), (2, "c", "s")]), budget="all").collect()
    assert [r.copies for r in one] == [1, 1] and all(r.weight == 1 for r in one)


def test_empty_table(spark):
    assert M.mix_sources(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    assert M.mix_sources(spark.createDataFrame([], DOC_SCHEMA), budget="all").count() == 0
    assert [r.copies for r in M.mix_sources(documents(spark, [(1, ""), (2, None)])).collect()] == [1, 1]
