"""Source divergence audit: how far the word use of a language's sources differs.

Late string materialization. Tasks count the terms of their own documents first
and write (lang, source, digest, term, occurrences, documents) in columns; every
count is then shuffled under a 64-bit digest of the term, never under its text.
Of the digests that are frequent enough to be kept, the least and the greatest
text are compared: where they differ, two terms share a digest, and that digest's
counts are split by text. The texts of terms come back for the output rows only.

Two parts for each (lang, source) group, ranked by value:

* ``pair``: every other source of the language, with the divergence of the two
  smoothed term distributions. Terms are dealt over tasks by their digest and
  sources in blocks of ``block``, so a task holds a bounded matrix however many
  terms a language or sources a term has; pairs of sources are summed per task.
* ``term``: the ``top`` kept terms that the source uses more than its language.

All arithmetic is exact (integers; decimals where a product could exceed 64 bits).

Defined results: null text, lang and source count as empty; every row is a
document of its own, repeated rows too; a group without terms has its pairs, and
a language without kept terms has pairs of value 0; ties rank by the item's UTF-8
bytes; very long texts are counted whole, a task's memory follows its longest text; columns beyond
text, lang and source are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haze.functions.joins import maybe_broadcast
from haze.llm.common import written

MIN_DOCUMENTS, TOP, BLOCK, TERMS_A_TASK = 10, 10, 64, 4096
SCALE = 1_000_000_000
_HELD = 400_000  # terms that a task counts before it passes them on

# Runs of letters A-Z, a-z and characters beyond ASCII are terms; A-Z are lower-cased.
_SPLIT = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        held.clear()
    for batch in batches:
        for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            terms = text.translate(_SPLIT).split()
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in held.values()) >= _HELD:
            yield from passed_on()
    yield from passed_on()


def term_counts(docs: DataFrame, digest_bits: int = 64) -> DataFrame:
    """(lang, source, digest, term, n, docs), counted within each task; written once."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*text).select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        _counted, "lang string, source string, term binary, n long, docs long")
    digest = F.shiftrightunsigned(F.xxhash64("term"), 64 - digest_bits)
    return written(rows.select("lang", "source", digest.alias("digest"), F.col("term").cast("string").alias("term"), "n", "docs"),
                   "divergence-counts")


def _split(counts: DataFrame, parts: DataFrame, frequent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counts with ``part``, texts): digests whose least and greatest text differ are
    counted by text, each text a part of its own; all others are part 0."""
    texts = written(parts.join(maybe_broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(
        F.min("term").alias("term"), F.max("term").alias("most")), "divergence-texts")
    shared = texts.filter("term <> most").select("digest")
    whole = counts.withColumn("part", F.lit(0))
    if shared.isEmpty():
        return whole, texts.select("digest", F.lit(0).alias("part"), "term")
    few = maybe_broadcast(shared)
    again = written(parts.join(few, "digest", "left_semi").groupBy("lang", "source", "digest", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-split")
    part = F.row_number().over(Window.partitionBy("digest").orderBy("term")) - 1
    names = again.select("digest", "term").distinct().withColumn("part", part)
    counts = whole.join(few, "digest", "left_anti").unionByName(again.join(names, ["digest", "term"]).drop("term"))
    plain = texts.filter("term = most").select("digest", F.lit(0).alias("part"), "term")
    return counts, plain.unionByName(names.select("digest", "part", "term"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact; null without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    below = (total + 2 * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", top, F.when(below > 0, below)).cast("long"))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(key, rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Divergence of each pair of sources of two blocks, summed over the terms of one
    task that any of them has. groups: (idx, p0, block) of the blocks' sources."""
    low, high = int(key[1]), int(key[2])
    groups = groups.sort_values("idx")
    blocks = groups.idx.to_numpy() // groups.block.to_numpy()
    term = rows.groupby(["digest", "part"], sort=False).ngroup().to_numpy()
    terms = int(term.max()) + 1 if len(term) else 0
    idx, base = groups.idx.to_numpy(), groups.p0.fillna(0).to_numpy(np.int64)
    matrix = np.repeat(base[:, None], terms, axis=1)  # a row for each source
    matrix[np.searchsorted(idx, rows.idx.to_numpy()), term] = rows.p.to_numpy(np.int64)
    a_side, b_side = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    out = []
    for a in a_side:
        others = b_side[idx[b_side] > idx[a]]
        p, q = matrix[a][None, :], matrix[others]
        value = ((p - q) * (p - q) // np.maximum(p + q, 1)).sum(axis=1)
        out.append(pd.DataFrame({"lang": key[0], "a": idx[a], "b": idx[others], "value": value, "terms": terms}))
    return pd.concat(out) if out else pd.DataFrame({"lang": [], "a": [], "b": [], "value": [], "terms": []})


def _pairs(kept: DataFrame, groups: DataFrame, block: int, terms_a_task: int) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language. kept: (lang,
    digest, part, idx, p, terms); groups: (lang, source, idx, sources, terms, p0)."""
    salts = F.greatest(F.lit(1), F.ceil(F.col("terms") / terms_a_task)).cast("long")
    own = F.floor(F.col("idx") / block).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / block).cast("int"))).alias("other")

    def keyed(df: DataFrame, salt: Column, *columns) -> DataFrame:
        df = df.withColumn("salt", salt).withColumn("own", own).select("*", others)
        return df.select(F.col("lang").alias("lang"), F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                         F.col("salt").alias("salt"), *(F.col(c).alias(c) for c in columns))
    keys = ["lang", "low", "high", "salt"]
    rows = keyed(kept, F.pmod("digest", salts), "digest", "part", "idx", "p")
    sides = keyed(groups.withColumn("block", F.lit(block)), F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)), "idx", "p0", "block")
    sums = (rows.groupBy(*keys).cogroup(sides.groupBy(*keys))
            .applyInPandas(_pair_sums, "lang string, a long, b long, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("seen")))

    def named(side: str) -> DataFrame:
        return maybe_broadcast(groups.select("lang", F.col("idx").cast("long").alias(side), F.col("source").alias(f"{side}_source"),
                                             F.col("p0").alias(f"{side}_p0"), *(["terms"] if side == "a" else [])))
    both = sums.join(named("a"), ["lang", "a"]).join(named("b"), ["lang", "b"])
    unseen = (F.col("terms") - F.col("seen")) * _gap(F.col("a_p0"), F.col("b_p0"))  # terms that neither block's sources have
    both = both.select("lang", "a_source", "b_source", (F.col("value") + F.coalesce(unseen, F.lit(0))).alias("value"))
    sides = F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
                    F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))
    return both.select("lang", F.inline(sides), "value").select("lang", "source", "item", "value")


def _top_terms(used: DataFrame, texts: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the ``top`` terms of each group. The values
    that reach the ranks are found first, so texts are joined to few terms."""
    group = ["lang", "source"]
    distinct = used.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("terms"))
    best = Window.partitionBy(*group).orderBy(F.col("value").desc())
    distinct = distinct.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top)
    before = F.coalesce(F.sum("terms").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = distinct.withColumn("before", before).filter(F.col("before") < top).select(*group, "value")
    named = used.join(values, [*group, "value"], "left_semi").join(texts, ["digest", "part"])
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("value").desc(), "term"))
    return named.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        *group, F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, block: int = BLOCK,
          terms_a_task: int = TERMS_A_TASK, digest_bits: int = 64) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``."""
    parts = term_counts(docs, digest_bits)
    counts = parts.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "divergence-sums")
    frequent = (counts.groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_documents)
                .select("digest").distinct())
    counts, texts = _split(counts, parts, frequent)
    over = Window.partitionBy("lang", "digest", "part")  # one row for each source
    kept = written(counts.withColumn("lang_docs", F.sum("docs").over(over)).filter(F.col("lang_docs") >= min_documents)
                   .withColumn("lang_n", F.sum("n").over(over)).withColumn("first", F.row_number().over(over.orderBy("source")) == 1)
                   .select("lang", "source", "digest", "part", "n", "lang_n", "first"), "divergence-kept")

    once = F.when(F.col("first"), 1)
    langs = kept.groupBy("lang").agg(F.count(once).alias("terms"), F.sum("n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    name = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    by_lang = Window.partitionBy("lang")
    groups = docs.select(*name).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    groups = groups.withColumn("idx", F.row_number().over(by_lang.orderBy("source")) - 1).withColumn(
        "sources", F.count(F.lit(1)).over(by_lang)).withColumn("p0", _share(F.lit(0), F.col("total"), F.col("terms")))
    groups = written(groups, "divergence-groups")

    known = maybe_broadcast(groups.select("lang", "source", "idx", "sources", "terms", "total", "lang_total"))
    kept = kept.join(known, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    used = kept.withColumn("q", q).filter("n > 0 and p > q").select(
        "lang", "source", "digest", "part", _gap(F.col("p"), F.col("q")).alias("value"))
    terms = _top_terms(written(used, "divergence-used"), texts, top)
    pairs = _pairs(kept, groups, block, terms_a_task)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.withColumn("kind", F.lit("pair")).unionByName(terms.withColumn("kind", F.lit("term"))).select(
        "lang", "source", F.col("kind").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
