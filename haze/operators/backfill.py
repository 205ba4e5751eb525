"""Backfill: day spine, resume ledger, date-filtered replays.

All pending days run in one job: the readings are joined to the pending-day
spine (its size is fixed by the requested date range, so broadcasting it is
safe) and written into the raw tables' own layout (``load_id=...``) with dynamic
partition overwrite, so a replayed day replaces its own files and nothing else.
The ledger (a small table of done days) is appended after the data write succeeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haze import sinks
from haze.functions.exprs import parse_local_datetime
from haze.functions.joins import maybe_broadcast
from haze.operators import validate
from haze.session import checkpoint_root, ensure_utc
from haze.snapshots import Warehouse
from haze.sources import landing


def day_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive (column ``day``)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))


def pending_days(spine: DataFrame, ledger: DataFrame) -> DataFrame:
    """Spine days not yet in the ledger (anti join)."""
    done = ledger.select(F.col("day").cast("date").alias("day"))
    return spine.join(maybe_broadcast(done), "day", "left_anti")


def rows_on_days(rows: DataFrame, ts_col: str, days: DataFrame) -> DataFrame:
    """Rows whose UTC date of ``ts_col`` is one of ``days``; adds ``<ts_col>``'s
    date as ``reading_date``. ``days`` is bounded by the requested range."""
    ensure_utc(rows.sparkSession)
    d = maybe_broadcast(days.select(F.col("day").alias("_day")))
    return rows.join(d, F.to_date(F.col(ts_col)) == F.col("_day"), "inner") \
        .withColumnRenamed("_day", "reading_date")


def backfill_readings(spark: SparkSession, landing_path: str, start: str, end: str,
                      ledger_path: str, out_path: str, run_ts: Column,
                      quarantine_path: str | None = None, multiline: bool = True,
                      fallback_first: bool = True) -> int:
    """Replay landed AQI pages for the pending days of [start, end].

    Records are validated (``fallback_first``: archived records may carry
    ``pollutant_*`` names only), normalized, kept when their UTC reading date is
    pending, and written to the raw table as load ``backfill-<day>``, which a
    replay replaces. Failures dated on a pending day or not at all go to the
    quarantine (default: ``invalid_records`` beside the raw table), replacing
    those of an earlier try. Only days that got rows are
    closed in the ledger. Returns rows written.
    """
    pending = pending_days(day_spine(spark, start, end), sinks.read_table(spark, ledger_path, "day date"))
    checkpoint_root(spark)
    pending = pending.checkpoint()  # tiny, and read again after the ledger grows: pin it
    if pending.isEmpty():
        return 0
    quarantine_path = quarantine_path or f"{out_path.rstrip('/').rpartition('/')[0]}/invalid_records"
    records = landing.aqi_records(landing.read_aqi_pages(spark, landing_path, multiline))
    checked = validate.validate_readings(records, fallback_first).persist()
    try:
        day = F.to_date(parse_local_datetime("last_update"))
        days = maybe_broadcast(pending.select(F.col("day").alias("_day")))
        failed = checked.where(F.col("error_field").isNotNull())
        for part, load in ((failed.where(day.isNull()), F.lit(f"backfill-undated-{start}-{end}")),
                           (failed.join(days, day == F.col("_day"), "left_semi"), F.concat(F.lit("backfill-"), day.cast("string")))):
            bad = validate.quarantine_rows(part.withColumn("_load", load), "aqi", run_ts, keep=("_load",))
            sinks.overwrite_partitions(bad.drop("source").withColumnRenamed("_load", "load_id"), f"{quarantine_path}/source=aqi", ["load_id"])
        good = validate.normalize_readings(checked.where(F.col("error_field").isNull()), run_ts)
        rows = rows_on_days(good, "reading_timestamp", pending)
        rows = rows.withColumn("load_id", F.concat(F.lit("backfill-"), F.col("reading_date").cast("string"))).drop("reading_date")
        n = sinks.overwrite_partitions(rows, out_path, ["load_id"])
        done = rows_on_days(good, "reading_timestamp", pending).select(F.col("reading_date").alias("day")).distinct()
        sinks.write_table(done, ledger_path, "append")
    finally:
        checked.unpersist()
    return n


def backfill_weather(spark: SparkSession, archive_path: str, start: str, end: str,
                     out_path: str, run_ts: Column, cities: DataFrame | None = None,
                     wind_unit: str = "as_is", multiline: bool = True) -> int:
    """Explode landed archive payloads for [start, end] (and the given cities)
    into raw weather rows, one folder ``archive-<date>`` for each date however many
    cities it has. A replay replaces the same dates of the same cities and nothing
    else: the stored rows of a date's other cities are copied. Returns archive rows
    written."""
    ensure_utc(spark)
    rows = landing.hourly_rows(landing.read_archive(spark, archive_path, multiline), run_ts, wind_unit)
    day = F.to_date("recorded_at")
    rows = rows.where(day.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    if cities is not None:
        rows = rows.join(maybe_broadcast(cities.select("city")), "city", "left_semi")
    rows = rows.withColumn("load_id", F.concat(F.lit("archive-"), day.cast("string")))
    stored = sinks.read_table(spark, out_path, rows.schema).where(
        F.col("load_id").between(f"archive-{start}", f"archive-{end}")).select(rows.columns)
    if stored.isEmpty():
        return sinks.overwrite_partitions(rows, out_path, ["load_id"], ["city"])
    rows = sinks.pinned(rows, "backfill-weather")
    named = rows.select(F.col("load_id").alias("_l"), F.col("city").alias("_c")).distinct()
    others = stored.join(named, (stored["load_id"] == F.col("_l")) & stored["city"].eqNullSafe(F.col("_c")), "left_anti")
    touched = others.join(named.select(F.col("_l").alias("load_id")).distinct(), "load_id", "left_semi").select(rows.columns)
    both = sinks.pinned(rows.unionByName(touched), "backfill-weather")  # read in full before its folders are replaced
    sinks.overwrite_partitions(both, out_path, ["load_id"], ["city"])
    return rows.count()


def backfill_weather_dates(warehouse: Warehouse, archive_path: str, start: str, end: str, run_ts: Column,
                           cities: DataFrame | None = None, wind_unit: str = "as_is", multiline: bool = True,
                           table: str = "raw_weather") -> set[str]:
    """The same into a warehouse, whose raw table lies by date and is read by date: one
    folder for each date, published at once. Returns the dates that changed."""
    ensure_utc(warehouse.spark)
    rows = landing.hourly_rows(landing.read_archive(warehouse.spark, archive_path, multiline), run_ts, wind_unit)
    day = F.to_date("recorded_at")
    rows = rows.where(day.between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    if cities is not None:
        rows = rows.join(maybe_broadcast(cities.select("city")), "city", "left_semi")
    tx = warehouse.begin()
    dates = tx.replace_keys(table, rows, day, ["city"], cluster_by=("city",))
    tx.commit()
    return dates
