import os
import random
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import DOC_SCHEMA, documents  # noqa: E402

from haze.llm import token_counts as T  # noqa: E402


def greedy(word, first, inner):
    n, at = 0, 0
    while at < len(word):
        pieces = first if at == 0 else inner
        size = next((k for k in range(len(word) - at, 1, -1) if word[at:at + k] in pieces), 1)
        n, at = n + 1, at + size
    return n


def test_automaton_matches_greedy_matching():
    r = random.Random(5)
    for _ in range(40):
        first = {bytes(r.choices(b"abc", k=r.randint(1, 6))) for _ in range(r.randint(0, 12))}
        inner = {bytes(r.choices(b"abc", k=r.randint(1, 6))) for _ in range(r.randint(0, 20))}
        automaton = T.Automaton(first, inner)
        for _ in range(200):
            word = bytes(r.choices(b"abcd", k=r.randint(1, 25)))
            assert automaton.count(word) == greedy(word, first, inner), (word, first, inner)


def test_documents_with_the_vocabulary(spark):
    first, inner = T.read_vocabulary()
    rows = [(1, "The quick brown fox, anticonstitutionnellement!"), (2, None), (3, ""), (4, " \t\n"), (5, "naïve 東京 x"),
            (6, "z" * 200_000), (7, "a " * 100_000), (None, "null id"), (1, "The quick brown fox, anticonstitutionnellement!")]
    docs = documents(spark, rows).withColumn("n_words", F.lit("x")).withColumn("n_tokens", F.lit("x"))
    got = sorted(map(tuple, T.count_tokens(docs).collect()), key=str)
    want = []
    for i, t in rows:
        ws = (t or "").encode().split()
        want.append((i, len(ws), sum(greedy(w, first, inner) if len(w) < 1000 else T.Automaton(first, inner).count(w) for w in ws)))
    assert got == sorted(want, key=str)


def test_byte_alphabet_covers_all_bytes():
    assert sorted(T.byte_alphabet().values()) == list(range(256))


def test_empty_table(spark):
    assert T.count_tokens(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
