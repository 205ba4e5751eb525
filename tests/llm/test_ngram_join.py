import os
import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import ngram_join as J  # noqa: E402
from haze.llm.components import components  # noqa: E402


def _set(text, n):
    ws = (text or "").encode().lower().split()
    return J.shingle_set(ws, n)


def brute(rows, n, percent):
    """{id: component} by comparing all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = [(i, _set(t, n)) for i, t in rows if i is not None]
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i in ids}


def corpus(seed, docs=60, vocab=400):
    """Texts of many lengths, with chains of near copies around the threshold."""
    r = random.Random(seed)
    rows, i = [], 0
    while len(rows) < docs:
        ws = [f"w{r.randrange(vocab)}" for _ in range(r.choice([1, 2, 3, 4, 8, 12, 20, 40, 90, 200]))]
        for _ in range(r.choice([1, 1, 2, 5])):
            rows.append((i, r.choice([" ", "\n"]).join(ws)))
            i += 1
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                k = r.randrange(len(ws))
                ws = ws[:k] + r.choice([[], [f"n{r.randrange(99)}"], [ws[k], "x"]]) + ws[k + 1:]
                ws = ws or ["e"]
    return rows


@pytest.mark.parametrize("n,percent,seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_components_match_brute_force(spark, n, percent, seed):
    rows = corpus(seed)
    got = {r.id: (r.n_shingles, r.component) for r in J.jaccard_components(documents(spark, rows), n, percent).collect()}
    want = brute(rows, n, percent)
    assert {i: c for i, (_, c) in got.items()} == want
    assert {i: s for i, (s, _) in got.items()} == {i: len(_set(t, n)) for i, t in rows}


@pytest.mark.parametrize("deletions,spare,least", [(True, 0, 1), (False, 0, 1), (False, 3, 1), (False, 4, 2), (False, 9, 3)])
@pytest.mark.parametrize("percent", [60, 80, 90])
def test_every_linked_pair_shares_a_signature(deletions, spare, least, percent):
    """Completeness of both allocations, whatever the cost model picks."""
    r = random.Random(percent + spare)
    edges = J.band_edges(400, percent)
    plan = [J.Allocation(J.max_difference(edges[k + 1] - 1, percent), deletions, spare, least) for k in range(len(edges) - 1)]
    linked = 0
    for _ in range(1500):
        size = r.choice([1, 2, 5, 9, 10, 12, 19, 30, 60, 200])
        a = set(r.sample(range(10**6), size))
        b = set(a)
        for _ in range(r.randrange(J.max_difference(size, percent) + 2)):
            b ^= {r.choice(sorted(b))} if b and r.random() < .5 else {r.randrange(10**6)}
        if not b or 100 * len(a & b) < percent * len(a | b):
            continue
        linked += 1
        keys = []
        for s in (a, b):
            with np.errstate(over="ignore"):
                h = J.mix(np.array(sorted(s), dtype=np.uint64) + np.uint64(1))
                keys.append(J.set_signatures(np.sort(h), edges, plan, percent))
        whole = [set((k >> 1)[(k & 1) == 0].tolist()) for k in keys]
        every = [set((k >> 1).tolist()) for k in keys]
        assert whole[0] & every[1] or whole[1] & every[0], (a, b)
    assert linked > 300


def test_hand_made_cases(spark):
    long = " ".join(f"q{i}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "One  two"), (9, "one\ntwo"), (10, "two one"), (12, long),
            (11, long + " tail"), (13, "One two"), (None, "one two"), (None, None), (13, "solo words here now")]
    docs = documents(spark, rows).withColumn("class", F.lit(1)).withColumn("id", F.lit(2)).withColumn("rep", F.lit(3))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.join_report(docs).collect()), key=str)
    assert got == sorted([(5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (10, 1, 10), (12, 29998, 11),
                          (11, 29999, 11), (13, 1, 8), (13, 2, 8), (None, 1, None), (None, 0, None)], key=str)


def test_empty_table(spark):
    assert J.join_report(spark.createDataFrame([], DOC_SCHEMA)).count() == 0


def test_large_group_of_near_copies_and_hot_signatures(spark, monkeypatch):
    base = [f"b{i}" for i in range(120)]
    rows = [(i, " ".join(base[:60] + [f"v{i}"] + base[60:])) for i in range(300)]
    rows += [(1000 + i, f"other {i} words with nothing shared {i * 7}") for i in range(30)]
    got = {r.doc_id: r.component_id for r in J.join_report(documents(spark, rows)).collect()}
    assert got == brute(rows, 3, 90)


def test_clusters_cut_into_blocks(spark, monkeypatch):
    """Copies at all distances around the threshold, compared block by block."""
    monkeypatch.setattr(J, "_BLOCK", 16)
    r = random.Random(9)
    rows = []
    for i in range(150):
        ws = [f"b{k}" for k in range(150)]
        for _ in range(r.randrange(9)):
            ws[r.randrange(150)] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(ws[:150 - r.randrange(30)])))
    got = {r.doc_id: r.component_id for r in J.join_report(documents(spark, rows)).collect()}
    want = brute(rows, 3, 90)
    assert got == want and len(set(want.values())) > 20


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_sketches_refute_no_linked_pair():
    rng = np.random.default_rng(8)
    for percent in (50, 80, 90, 100):
        members, sets = [], []
        for k in range(60):
            base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.7 else rng.integers(0, 1 << 63, int(rng.integers(1, 400)), np.uint64)
            kept = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.1, 0.3])]
            grown = np.unique(np.concatenate((kept, rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(base) // 5)), np.uint64))))
            sets.append(grown)
            members.append((k, len(grown), k, J.sketch(grown)))
        near = J.near_sketches(members, percent)
        linked = {i for i in range(60) for j in range(60) if i != j and len(sets[i]) and len(sets[j])
                  and 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
        assert linked <= near and len(near) < 60, percent
        assert not J.near_sketches([(i, n, 0, sk) for i, n, _, sk in members], percent)  # one label: connected already


def test_a_chain_of_weak_buckets_is_compared_by_bucket(spark):
    chain = [(key, rep, key) for key in range(10_000) for rep in (key, key + 1)]  # one cluster of 10,001 classes
    again = [(20_000 + key, rep, key) for key in range(10_000) for rep in (key, key + 1)]  # equal buckets count once
    small = [(50_000, 60_000 + i, 60_000) for i in range(5)]
    rest = spark.createDataFrame(chain + again + small, "key long, rep long, least long")
    got = {}
    for r in J._candidates(rest).collect():
        got.setdefault(r.component, []).append(r.node)
    assert sorted(map(sorted, got.values())) == [[key, key + 1] for key in range(10_000)] + [[60_000 + i for i in range(5)]]


def test_a_large_family_in_many_buckets_stays_one_cluster(spark):
    rest = spark.createDataFrame([(key, rep, 0) for key in range(20) for rep in range(2000) if rep == 0 or rep % 21 != key], "key long, rep long, least long")
    got = J._candidates(rest)
    assert got.count() == got.select("node").distinct().count() == 2000 and got.select("component").distinct().count() == 1


@pytest.mark.parametrize("bucket_rows", [0, 10 ** 9])
def test_components_by_bucket_and_by_cluster(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(J, "_BLOCK", 3)
    monkeypatch.setattr(J, "_BUCKET_ROWS", bucket_rows)
    rows = corpus(11, docs=120, vocab=25)
    got = {r.id: r.component for r in J.jaccard_components(documents(spark, rows), 1, 60).collect()}
    assert got == brute(rows, 1, 60)


def test_near_groups_are_apart():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 63, 200, np.uint64)) for _ in range(2)]
    members = [(10 * k + c, 200 - c, 10 * k + c, J.sketch(b[c:])) for k, b in enumerate(base) for c in range(3)]
    assert sorted(J.near_groups(members, 80)) == [[0, 1, 2], [10, 11, 12]]
    assert J.near_groups(members[:1], 80) == J.near_groups([], 80) == []


def _packed_part(sets=4, keys=500_000):
    """One part's rows as map tasks give them; the first two sets share every fifth of their keys."""
    rng = np.random.default_rng(5)
    columns = [[] for _ in range(6)]
    for node in range(sets):
        mine = rng.integers(0, 1 << 40, keys, np.int64) & ~np.int64(1)
        if node == 1:
            mine[::5] = first[::5]
        first = mine if node == 0 else first
        for c, x in zip(columns, (0, 7, J._packed(mine), np.array([node], np.int64).tobytes(), np.array([keys], np.uint32).tobytes(), False)):
            c.append(x)
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["deal", "part", "keys", "nodes", "runs", "hot"])


def test_a_part_is_sorted_in_bounded_memory():
    batch = _packed_part()
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in J._shared(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows >= 200_000 and peak < 80e6  # 2,000,000 keys, of which 8 bytes each and their classes are 32 MB


def test_a_part_gives_the_same_rows_in_ranges(monkeypatch):
    batch = _packed_part(keys=2000)
    got = []
    for held in (10 ** 9, 100):
        monkeypatch.setattr(J, "_SORTED_KEYS", held)
        got.append(sorted(r for b in J._shared(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))))
    assert got[0] == got[1] and len(got[0]) == 800


def test_only_near_sketches_ask_for_texts(spark, monkeypatch):
    """Partners that their sketches refute get no text; linked ones do, whatever their widths."""
    monkeypatch.setattr(J, "_texts_of", lambda ids, texts, f=J._texts_of: asked.append(sorted(r.id for r in ids.distinct().collect())) or f(ids, texts))
    asked = []
    texts = {0: " ".join(f"a{i}" for i in range(70)), 2: " ".join(f"b{i}" for i in range(70))}
    texts[1], texts[3] = texts[0].rsplit(" ", 6)[0], texts[2] + " a0 a1"
    with np.errstate(over="ignore"):
        sets = {i: J.shingle_hashes(J.words(t), 3) for i, t in texts.items()}
    assert len(J.sketch(sets[0])) > len(J.sketch(sets[1]))
    sketches = spark.createDataFrame([(i, len(h), bytearray(J.sketch(h))) for i, h in sets.items()], "id long, n_shingles long, sketch binary")
    pairs = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (3, 1), (3, 2)], "a long, b long")
    found = J._verified(pairs, spark.createDataFrame(list(texts.items()), "id long, text string"), sketches, 3, 80)
    assert sorted((r.a, r.b) for r in found.collect()) == [(1, 0), (3, 2)] and asked == [[0, 1, 2, 3]]
    asked.clear()
    assert J._verified(pairs.filter("b = 0 and a > 1"), spark.createDataFrame(list(texts.items()), "id long, text string"), sketches, 3, 80).count() == 0
    assert asked == [[]]
