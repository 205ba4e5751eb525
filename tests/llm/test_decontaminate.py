import os
import random
import sys
from collections import Counter

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import decontaminate as D  # noqa: E402


def brute(rows, items):
    """All windows of every item's length against the item."""
    out = {}
    for i, t in rows:
        ws = (t or "").encode().lower().split()
        for j, u in items:
            vs = (u or "").encode().lower().split()
            n = min(5, len(vs))
            if not vs:
                continue
            bag = Counter(tuple(vs[k:k + n]) for k in range(len(vs) - n + 1))
            best = 0.0
            for a in range(len(ws) - len(vs) + 1):
                win = Counter(tuple(ws[k:k + n]) for k in range(a, a + len(vs) - n + 1))
                both = sum((win & bag).values())
                sim = both / (sum(win.values()) + sum(bag.values()) - both)
                if sim >= 0.8 and sim > best:
                    best = sim
                    out[i, j] = (sim, a, len(vs))
    return out


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def _corpus(seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(60)}"
    items = [(j, " ".join(word() for _ in range(r.choice([1, 3, 4, 5, 6, 15, 20, 40, 59])))) for j in range(30)]
    rows = []
    for i in range(80):
        text = [word() for _ in range(r.randrange(120))]
        for _ in range(r.randrange(3)):
            part = r.choice(items)[1].split()
            for _ in range(r.randrange(3)):
                k = r.randrange(len(part) + 1)
                part[k:k + r.randrange(2)] = r.choice([[], [word()], [word().upper()]])
            at = r.randrange(len(text) + 1)
            text[at:at] = part
        rows.append((i, "\n ".join(text)))
    return rows, items


def _got(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.start, r.words) for r in df.collect()}


def test_matches_equal_brute_force(spark):
    for seed in (1, 2):
        rows, items = _corpus(seed)
        want = brute(rows, items)
        got = _got(D.find_contamination(documents(spark, rows), _items(spark, items), block_bytes=900))
        assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()} and len(want) > 60
        assert all(abs(got[k][0] - want[k][0]) < 1e-12 for k in want)


def test_hand_made_cases(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, f"x {item} y"), (2, None), (3, ""), (4, item.upper()), (None, item), (5, item.replace("six", "sixty")), (6, "w " * 60_000 + item),
            (1, f"x {item} y"), (7, item.replace(" ", "\t\n")), (8, "clean words only")]
    docs = documents(spark, rows).withColumn("item_id", F.lit(1)).withColumn("similarity", F.lit(0)).withColumn("start", F.lit(0))
    items = _items(spark, [(10, item), (11, None), (12, ""), (10, item), (13, "tiny"), (None, "short item")])
    got = sorted((r.doc_id or 0, r.item_id, r.start, r.words) for r in D.find_contamination(docs, items).collect())
    want = [(i, 10, s, 12) for i, s in ((0, 0), (1, 1), (1, 1), (4, 0), (6, 60_000), (7, 0)) for _ in range(2)]
    assert got == sorted(want)
    left = D.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 5, 8]


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], DOC_SCHEMA), _items(spark, [])
    assert D.find_contamination(none, _items(spark, [(1, "a b c d e f")])).count() == 0
    docs = documents(spark, [(1, "a b")])
    assert D.find_contamination(docs, items).count() == 0 and D.drop_contaminated(docs, items).count() == 1


def test_planted_items_of_the_test_tables_are_found(spark):
    base = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    got = {k for k, v in _got(D.find_contamination(docs, items)).items()}
    plain = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
    whole = {(i, r.item_id) for r in items.collect() for i, t in plain.items() if " ".join(r.text.lower().split()) in t}
    assert whole and whole <= got


def brute_whole(rows, items):
    """brute(), where a document with fewer words than the item is one window."""
    out = brute(rows, items)
    for i, t in rows:
        ws = (t or "").encode().lower().split()
        for j, u in items:
            vs = (u or "").encode().lower().split()
            n = min(5, len(vs))
            if len(ws) < len(vs):
                win, bag = (Counter(tuple(x[k:k + n]) for k in range(len(x) - n + 1)) for x in (ws, vs))
                both = sum((win & bag).values())
                sim = both / (sum(win.values()) + sum(bag.values()) - both)
                if sim >= 0.8:
                    out[i, j] = (sim, 0, len(ws))
    return out


def test_documents_shorter_than_the_item(spark):
    item = [f"w{k}" for k in range(20)]
    parts = {1: item[:18], 2: item[1:], 3: item[1:19], 4: item[:16], 5: item[:9] + ["x"] + item[10:19], 6: item[:3], 7: item[2:] + ["x"], 8: item[:19]}
    r = random.Random(5)
    items = [(100, " ".join(item))] + [(j, " ".join(f"v{r.randrange(40)}" for _ in range(r.choice([3, 5, 6, 9, 13, 30, 60])))) for j in range(40)]
    rows = [(i, " ".join(p)) for i, p in parts.items()]
    for i in range(400):
        part = r.choice(items)[1].split()
        a, b = r.randrange(4), r.randrange(4)
        rows.append((1000 + i, " ".join(part[a:len(part) - b])))
    want = brute_whole(rows, items)
    assert {i for i, j in want if j == 100 and i < 1000} == {1, 2, 3, 7, 8} and len(want) > len(brute(rows, items)) + 100
    got = _got(D.find_contamination(documents(spark, rows), _items(spark, items), block_bytes=900))
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 for k in want)
    left = D.drop_contaminated(documents(spark, rows), _items(spark, items)).collect()
    assert sorted(x.doc_id for x in left) == sorted(i for i, _ in rows if i not in {k[0] for k in want})
