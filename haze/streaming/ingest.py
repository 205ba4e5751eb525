"""Incremental ingestion with Structured Streaming.

``start_ingest``  landed AQI pages or weather objects -> validated good rows +
    quarantine rows. The file source's checkpoint remembers which files were
    processed (a second run over the same landing adds nothing). Each
    micro-batch is one load of the raw tables (``load_id=stream-...``), written
    with overwrite, so a retried batch replaces its own output.
``start_hourly_pivot``  raw readings -> wide station-hour rows; each micro-batch
    is merged into the station-hour table by replacing the dates it touches.
"""

from __future__ import annotations

import datetime as dt
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haze import schemas, sinks
from haze.functions.joins import maybe_broadcast
from haze.operators import staging, validate
from haze.session import checkpoint_root
from haze.sources import landing


def ingest_batch(records: DataFrame, load_id: str, readings_path: str,
                 quarantine_path: str, run_ts: dt.datetime | None = None) -> None:
    """Validate one micro-batch of records and write both outputs as one load."""
    stamp = F.lit(run_ts or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    checked = validate.validate_readings(records).persist()
    try:
        good = validate.normalize_readings(checked.where(F.col("error_field").isNull()), stamp)
        sinks.write_load(good, readings_path, load_id)
        sinks.write_quarantine(validate.quarantine_rows(checked, "aqi", stamp), quarantine_path, "aqi", load_id)
    finally:
        checked.unpersist()


def ingest_weather_batch(objects: DataFrame, load_id: str, readings_path: str,
                         quarantine_path: str, run_ts: dt.datetime | None = None) -> None:
    """The same for current-weather objects."""
    stamp = F.lit(run_ts or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
    checked = validate.validate_weather(objects).persist()
    try:
        sinks.write_load(validate.normalize_weather(checked.where(F.col("error_field").isNull()), stamp), readings_path, load_id)
        bad = validate.quarantine_rows(checked, "weather", stamp, payload=validate.weather_quarantine_payload())
        sinks.write_quarantine(bad, quarantine_path, "weather", load_id)
    finally:
        checked.unpersist()


def _load_prefix(checkpoint_path: str) -> str:
    """Batch numbers start anew with each checkpoint, so its name is part of the load id."""
    return f"stream-{zlib.crc32(checkpoint_path.encode()):08x}"


def start_ingest(spark: SparkSession, landing_path: str, readings_path: str,
                 quarantine_path: str, checkpoint_path: str, multiline: bool = True,
                 max_files_per_trigger: int | None = None,
                 available_now: bool = True, source: str = "aqi") -> StreamingQuery:
    """``source``: "aqi" pages or "weather" objects."""
    schema = schemas.AQI_PAGE if source == "aqi" else schemas.WEATHER_RECORD
    reader = spark.readStream.schema(schema).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.json(landing_path)
    rows, batch = (landing.aqi_records(landed), ingest_batch) if source == "aqi" else (landed, ingest_weather_batch)
    prefix = _load_prefix(checkpoint_path)
    writer = (rows.writeStream
              .foreachBatch(lambda df, bid: batch(df, f"{prefix}-{bid}", readings_path, quarantine_path))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _pivot(raw: DataFrame, city_map: DataFrame) -> DataFrame:
    return staging.stg_readings(raw, city_map)


def merge_hours(raw: DataFrame, city_map: DataFrame, out_path: str) -> None:
    """Merge one micro-batch of raw readings into the station-hour table.

    Every measure of a station-hour is a maximum, so the rows of the dates that
    the batch touches are combined with the batch's rows and those date
    partitions are replaced: late readings and hours still open are kept, and a
    repeated batch changes nothing.
    """
    part = _pivot(raw, city_map)
    keys = ["station_name", "canonical_city", "state", "reading_hour", "reading_date"]
    checkpoint_root(raw.sparkSession)
    part = part.checkpoint()
    have = sinks.read_table(raw.sparkSession, out_path, part.schema).select(part.columns)
    days = part.select(F.col("reading_date").alias("_day")).distinct()
    both = part.unionByName(have.join(maybe_broadcast(days), have.reading_date == F.col("_day"), "left_semi"))
    merged = both.groupBy(*keys).agg(*(F.max(c).alias(c) for c in part.columns if c not in keys)).select(part.columns)
    merged = merged.checkpoint()  # read in full before its partitions are replaced
    sinks.overwrite_partitions(merged, out_path, ["reading_date"])


def start_hourly_pivot(spark: SparkSession, readings_path: str, city_map: DataFrame,
                       out_path: str, checkpoint_path: str, max_files_per_trigger: int | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Streaming version of the station-hour pivot: complete after every batch,
    however the files are cut into batches."""
    reader = spark.readStream.schema(schemas.AQI_READINGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(readings_path).select(schemas.AQI_READINGS.fieldNames())
    writer = (raw.writeStream.foreachBatch(lambda df, _: merge_hours(df, city_map, out_path))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
