"""Against exact integers, written from the contract."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from haze.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string"
_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _brute(rows, least=10, top=10):
    n, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(c.lower() if c.isascii() else c for c in t) for t in _TERM.findall(text or "")]
        n[lang, source].update(terms)
        df[lang].update(set(terms))
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, d in df[lang].items() if d >= least)
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}
        q, p = shares(whole), {s: shares(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


def _rows(seed, sources=9, docs=240):
    rng = random.Random(seed)
    words = ["Wort", "élan", "ÉLAN", "data", "Data_set", "x1y", "ñandú", "zebra", "日本", "foo", "bar", "quux"] + [f"{a}{b}" for a in "abcdef" for b in "rstuv"]
    rows = []
    for i in range(docs):
        s = 0 if rng.random() < 0.4 else rng.randrange(sources)  # a hot source
        rows.append((i, " ".join(rng.choices(words, k=rng.randrange(0, 40))) + rng.choice([".", " 3.14", "\t-"]), rng.choice(["de", "en", None]), f"s{s}"))
    return rows + [(900, None, "fr", "x"), (901, "", "fr", None), (902, "uno dos", "fr", "y"), (903, "...", "de", "only marks"), (0, "again", "de", "s1"), (None, "again", "de", "s1")]


@pytest.mark.parametrize("settings", [{}, {"digest_bits": 4}, {"digest_bits": 6, "block": 2, "terms_a_task": 5}, {"min_documents": 1, "top": 3}])
def test_audit_matches_exact_arithmetic(spark, settings):
    rows = _rows(5)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit("t")).withColumn("idx", F.lit(3)).withColumn("digest", F.lit("d"))
    out = D.audit(docs, **settings)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert {tuple(r) for r in out.collect()} == _brute(rows, settings.get("min_documents", 10), settings.get("top", 10))


def test_ties_beyond_the_last_rank(spark):
    """A hundred terms of equal value: the first ten by their bytes."""
    terms = [f"t{chr(0x61 + i // 26)}{chr(0x61 + i % 26)}" for i in range(100)]
    rows = [(i, " ".join(terms), "en", "a") for i in range(10)] + [(50 + i, "other words here", "en", "b") for i in range(10)]
    got = {tuple(r) for r in D.audit(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == _brute(rows)
    assert [item for _, s, part, item, _, _ in sorted(got, key=lambda r: r[5]) if s == "a" and part == "term"] == terms[:10]


def test_counts_beyond_64_bits(spark):
    """10**9 * (n + 2) overflows a long from nine thousand million occurrences on."""
    n, total, terms = 40_000_000_003, 90_000_000_007, 12_345
    row = spark.range(1).select(D._share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (n + 2) // (total + 2 * terms)


def test_hand_made_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert D.audit(empty).count() == 0
    alone = D.audit(spark.createDataFrame([(1, None, None, None)], SCHEMA))
    assert alone.count() == 0  # one group, no other source, no terms
    long = [(i, "Wort " * 200_000, "de", "ab"[i % 2]) for i in range(10)]
    assert {tuple(r) for r in D.audit(spark.createDataFrame(long, SCHEMA)).collect()} == _brute(long)
