"""Corpus cleaning pipeline over ``documents``: each stage's rows are written as
Parquet and read again as the next stage's input.

Toxic documents go, then exact copies, then near copies (one document of each
component of the n-gram Jaccard join stays), then documents with a passage of the
benchmark; at last the sources that are left are mixed: every row with the number
of copies that its source's weight and the least budget that loses none give it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haze.llm import decontaminate, exact_dedup, mixing, ngram_join, toxicity
from haze.session import scratch_path


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_copies(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs, entropy=0.95, max_repeats=4.0, budget=None)


STAGES = [("toxicity", not_toxic), ("exact_dedup", exact), ("ngram_jaccard_join", near), ("decontamination", decontaminated),
          ("mixing", mixed)]

#: The stages train models and search candidates: not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
