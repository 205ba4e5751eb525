import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import documents  # noqa: E402
from test_decontaminate import brute as leaks  # noqa: E402
from test_ngram_join import brute as groups  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from haze.llm import toxicity  # noqa: E402
from haze.session import scratch_path  # noqa: E402

ITEM = "an exam item asks which of these seven words fits best here"


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choices("abcdefghij", k=r.randint(2, 6)))
    clean = [" ".join(word() for _ in range(r.randint(20, 60))) for _ in range(60)]
    rows = [(i, t, "hot" if i % 3 else f"s{i % 4}") for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i].upper(), "copy") for i in range(5)]  # exact copies, larger ids stay
    rows += [(200 + i, clean[10 + i] + " extra", "near") for i in range(5)]
    rows += [(300, f"{word()} {ITEM} {word()}", "leak"), (301, ITEM.upper(), "leak")]
    rows += [(400 + i, clean[20 + i] + " you stupid pathetic worthless moron", "toxic") for i in range(12)]
    rows += [(500, "", "empty"), (501, "  ", "empty"), (502, "tiny", "empty")]
    labels = [(i, 1, 0) for i in range(60)] + [(400 + i, 0, 1) for i in range(12)]
    root = scratch_path(spark, "pipeline-tables")
    documents(spark, rows).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, "unused item with some other words")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, tables)
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns if name != "mixing" else docs.columns == [*columns, "n_tokens", "weight", "copies"]
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}

    model, _ = toxicity._fitted(spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet"))
    assert kept["toxicity"] == {i: t for i, t in whole.items() if model.score(t) < toxicity.THRESHOLD}
    assert not any(400 <= i < 500 for i in kept["toxicity"]) and set(range(60)) <= set(kept["toxicity"])

    last = {t.encode().lower(): i for i, t in sorted(kept["toxicity"].items())}
    assert kept["exact_dedup"] == {i: kept["toxicity"][i] for i in last.values()}

    parts = groups(list(kept["exact_dedup"].items()), 5, 80)
    assert set(kept["ngram_jaccard_join"]) == {i for i, c in parts.items() if i == c}
    assert not any(200 <= i < 300 for i in kept["ngram_jaccard_join"])

    found = {i for i, _ in leaks(list(kept["ngram_jaccard_join"].items()), [(1, ITEM), (2, "unused item with some other words")])}
    assert set(kept["decontamination"]) == set(kept["ngram_jaccard_join"]) - found and found

    assert set(kept["mixing"]) == set(kept["decontamination"])
    rows = docs.collect()
    assert all(1 <= r.copies <= 5 for r in rows) and len({r.weight for r in rows if r.source == "hot"}) == 1


def test_run_is_the_registered_query(spark, tables):
    assert entry.queries()["pipeline"] is P.run
    names = [name for name, _ in P.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard_join", "decontamination", "mixing"]
    assert "doc_id" in P.run(spark, tables).columns
