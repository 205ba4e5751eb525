"""Helpers that the operators of this package share."""

from __future__ import annotations

import pickle
import string
from collections.abc import Callable, Iterable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haze.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the
    lineage, survives lost executors, and later readers do not recompute it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcasts a value (of a bounded size) together with its classes; the
    returned function gives it inside tasks."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    loaded: list = []

    def get():
        if not loaded:
            loaded.append(pickle.loads(data.value))
        return loaded[0]
    return get


def fresh(name: str, *frames: Iterable[str]) -> str:
    """A column name like ``name`` that none of the column lists has."""
    taken = {c.lower() for cols in frames for c in cols}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also changes other alphabets)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a whole text, split at ``[\\x20\\x09-\\x0D]+``:
    exactly what ``bytes.lower`` and ``bytes.split`` do on UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
