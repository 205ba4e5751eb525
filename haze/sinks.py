"""Table writers: append / overwrite / idempotent partition overwrite.

* ``write_table``       append or full refresh, returns the written row count
  (counted by an ``Observation`` during the write, no second job)
* partitioned tables    ``partition_by`` a date column (timestamps get a derived
  ``<col>_date`` partition column: day granularity)
* clustered tables      rows are rebalanced on the (partition, cluster) keys
  (hash, with AQE splitting skewed keys over several tasks, in one pass) and
  sorted within each file, so Parquet row-group min/max statistics skip by
  city; a plain ``repartition(date)`` would put a very large date in one task
* ``overwrite_partitions``  dynamic partition overwrite: replaying a day
  replaces exactly that day's files (idempotent backfill)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haze.session import scratch_path


def _layout(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    parts = []
    for c in partition_by:
        dtype = df.schema[c].dataType
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            df = df.withColumn(f"{c}_date", F.to_date(c))
            parts.append(f"{c}_date")
        else:
            parts.append(c)
    keys = [*parts, *cluster_by]
    if keys and cluster_by:
        # One pass: hash by (partition, cluster) keys; AQE splits a skewed key
        # over several tasks and merges small ones. Sorting each file by the
        # keys gives row groups tight min/max statistics on the cluster column.
        df = df.hint("rebalance", *keys).sortWithinPartitions(*keys)
    return df, parts


def write_table(df: DataFrame, path: str, mode: str = "append",
                partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                fmt: str = "parquet", skip_empty: bool = False) -> int:
    """Write ``df``; returns the number of rows written.

    ``skip_empty`` probes one row first and writes nothing for an empty frame
    (quarantine loads).
    """
    if skip_empty and df.limit(1).count() == 0:
        return 0
    df, parts = _layout(df, partition_by, cluster_by)
    obs = Observation("write")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode).format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.save(path)
    return int(obs.get["rows"])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                         cluster_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    df, parts = _layout(df, partition_by, cluster_by)
    obs = Observation("overwrite")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).save(path))
    return int(obs.get["rows"])


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table at ``path``; empty, with the schema, when it was never written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def pinned(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later readers
    neither recompute it nor see it change."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_load(df: DataFrame, path: str, load_id: str) -> int:
    """Write the rows of one load (a run, a stream batch) under
    ``<path>/load_id=<load_id>``, in place of what an earlier try of the same
    load wrote, also when it has no rows now."""
    return write_table(df, f"{path}/load_id={load_id}", "overwrite")


def write_quarantine(bad: DataFrame, path: str, source: str | None = None, load_id: str | None = None) -> int:
    """Quarantine envelopes, partitioned by source; a load's rows replace those of
    an earlier try (``<path>/source=<source>/load_id=<load_id>``). Writers of
    different sources never share a commit folder. Without a load the rows are
    appended (empty -> 0, no write).
    """
    if source is None:
        return write_table(bad, path, "append", partition_by=["source"], skip_empty=True)
    if load_id is None:
        return write_table(bad.drop("source"), f"{path}/source={source}", "append", skip_empty=True)
    return write_load(bad.drop("source"), f"{path}/source={source}", load_id)


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks as typed NULLs and put
    them in schema order (extra columns of ``df`` are kept at the end)."""
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create a catalog database if it does not exist yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_views(models: dict[str, DataFrame]) -> None:
    """Expose lazily evaluated models to SQL as temporary views."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
