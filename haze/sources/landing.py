"""Landed API payloads -> DataFrames (batch or streaming).

The HTTP fetch itself is outside the library: pages and objects land as files
(one JSON document per file, or JSON Lines) and are read with fixed schemas.

* ``aqi_records``      paged ``{"records": [...]}`` -> one row per record, with
  the untouched record text (``raw_payload``), its key list and parsed fields
* ``weather_objects``  one current-weather object per document
* ``hourly_rows``      archive payloads of parallel hourly arrays -> rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haze import schemas, sinks
from haze.functions.joins import maybe_broadcast
from haze.session import ensure_utc

# Archive wind speed units and their factor to m/s. The archive
# rows were historically stored without conversion ("as_is").
WIND_UNITS = {"as_is": 1.0, "ms": 1.0, "kmh": 1.0 / 3.6}


def read_aqi_pages(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Landed AQI pages (``multiline=True``: one page document per file)."""
    return spark.read.schema(schemas.AQI_PAGE).option("multiLine", multiline).json(path)


def aqi_records(pages: DataFrame) -> DataFrame:
    """Explode pages into records (works on batch and streaming frames).

    ``raw_payload`` is the record's own JSON text (kept for the quarantine),
    ``_keys`` its key list when a value field is NULL (a fallback field
    applies only to absent keys),
    and each API field is parsed as text. ``_unknown`` names a record that
    cannot be read at all: a malformed page (kept whole as one row, so it is
    quarantined rather than lost) or an array element that is not an object.
    """
    corrupt = F.col("_corrupt_record") if "_corrupt_record" in pages.columns else F.lit(None).cast("string")
    items = F.when(corrupt.isNull(), F.col("records")).otherwise(F.array(corrupt))
    rec = pages.select(
        F.col("_metadata.file_path").alias("source_file"),
        corrupt.isNotNull().alias("_bad_page"),
        F.posexplode(items).alias("record_pos", "raw_payload"),
    )
    # A column of its own: parsed once for all fields, not once for each.
    rec = rec.withColumn("_record", F.from_json("raw_payload", schemas.AQI_RECORD))
    parsed = F.col("_record")
    is_object = F.ltrim(F.col("raw_payload")).startswith("{")
    unknown = (F.when(F.col("_bad_page"), F.lit("malformed page"))
               .when(~is_object, F.lit("record is not a JSON object")))
    # The key list tells an absent key from a null one; it is only needed when
    # a value field is NULL, so the second parse is skipped for other records.
    some_value_null = (parsed["avg_value"].isNull() | parsed["min_value"].isNull()
                       | parsed["max_value"].isNull())
    keys = F.when(is_object & ~F.col("_bad_page") & some_value_null, F.json_object_keys("raw_payload"))
    return rec.select(
        "source_file", "record_pos", "raw_payload",
        keys.alias("_keys"),
        unknown.alias("_unknown"),
        *[parsed[f.name].alias(f.name) for f in schemas.AQI_RECORD.fields],
    )


def read_weather_objects(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Landed current-weather objects (leaves as text; see ``schemas``)."""
    return (spark.read.schema(schemas.WEATHER_RECORD).option("multiLine", multiline).json(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def landed_files(spark: SparkSession, landing_path: str, since: Column | None = None) -> DataFrame:
    """(path, modified) of the landed files, from ``since`` on; no content is read."""
    files = spark.read.format("binaryFile").load(landing_path)
    if since is not None:
        files = files.where(F.col("modificationTime") >= since)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"))


def of_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose ``source_file`` is among ``files`` (path); the names stay in Spark."""
    names = maybe_broadcast(files.select(F.col("path").alias("_path")))
    return rows.join(names, rows["source_file"] == F.col("_path"), "left_semi")


def with_request(objects: DataFrame, requests: DataFrame) -> DataFrame:
    """Adds ``requested_city``: the city whose request landed the object's file, by a landing
    manifest (path, city). NULL for files that the manifest does not list."""
    r = maybe_broadcast(requests.select(F.col("path").alias("_path"), F.col("city").alias("requested_city")))
    return objects.join(r, objects["source_file"] == F.col("_path"), "left").drop("_path")


def unloaded_files(spark: SparkSession, landing_path: str, ledger_path: str, load_id: str) -> list[str]:
    """Files of the landing folder that no other load has taken (a repeated load
    gets its own files again). Only names are read, no contents."""
    files = spark.read.format("binaryFile").load(landing_path).select("path")
    taken = sinks.read_table(spark, ledger_path, "path string, load_id string").filter(F.col("load_id") != load_id)
    return sorted(r.path for r in files.join(taken.select("path"), "path", "left_anti").collect())


def mark_loaded(spark: SparkSession, files: list[str], ledger_path: str, load_id: str) -> None:
    sinks.write_load(spark.createDataFrame([(f,) for f in files], "path string"), ledger_path, load_id)


def read_archive(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schemas.WEATHER_ARCHIVE).option("multiLine", multiline).json(path)


def hourly_rows(archive: DataFrame, fetched_at: Column, wind_unit: str = "as_is",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Parallel hourly arrays -> one raw weather row per ``time`` entry.

    Rows follow the ``time`` array; a shorter measure array gives NULL past its
    end, except precipitation, which gives 0.0 (an explicit JSON null stays
    NULL). Columns the archive does not carry are NULL.
    """
    ensure_utc(archive.sparkSession)
    factor = WIND_UNITS[wind_unit]
    h = F.col("hourly")
    rows = archive.select(*keep, "city", "hourly", F.posexplode(h["time"]).alias("_i", "_t"))
    i = F.col("_i")
    rain = h["precipitation"]
    null_d = F.lit(None).cast("double")
    return rows.select(
        *keep, "city",
        F.col("_t").try_cast("timestamp").alias("recorded_at"),
        F.get(h["temperature_2m"], i).alias("temp_celsius"),
        null_d.alias("feels_like_celsius"),
        F.get(h["relativehumidity_2m"], i).alias("humidity_pct"),
        (F.get(h["windspeed_10m"], i) * factor).alias("wind_speed_mps"),
        null_d.alias("wind_direction_degrees"),
        F.lit(None).cast("string").alias("weather_condition"),
        F.when(i < F.coalesce(F.size(rain), F.lit(0)), F.get(rain, i))
        .otherwise(F.lit(0.0)).alias("rainfall_1h_mm"),
        null_d.alias("visibility_meters"),
        null_d.alias("pressure_hpa"),
        fetched_at.cast("timestamp").alias("fetched_at"),
    )
