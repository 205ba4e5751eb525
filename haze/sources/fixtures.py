"""Raw inputs derived from the driver's tables (``events``, ``nation``).

There is no air-quality data under the test folders, so the raw tables are
views over ``events`` with arithmetic that DuckDB can repeat exactly (the
oracle queries in ``haze.plans.oracle`` use the same formulas). Every view
grows with ``events``: one reading / weather row / payload per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haze.functions.exprs import int_div

# The as-of instant used for freshness and recency metrics on
# the driver's tables (their events end on 2024-01-30).
AS_OF = "2024-01-30 23:30:00"
# The run stamp given to archive rows and the backfill window.
RUN_TS = "2024-01-31 00:00:00"
# Fixed value: metrics runs before it are stale at AS_OF.
STALE_BEFORE = "2024-01-20 00:00:00"
BACKFILL_START, BACKFILL_END = "2024-01-01", "2024-01-30"


# Fixed value: cities are N0..N27 by user; the three that are no nation key have no alias.
CITY_CODES = 28


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(key: Column, values: list, default) -> Column:
    """``CASE key WHEN 0 THEN values[0] ... ELSE default END``."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if not isinstance(v, Column) else v
        expr = F.when(key == i, lit) if expr is None else expr.when(key == i, lit)
    default = F.lit(default) if not isinstance(default, Column) else default
    return expr.otherwise(default)


def _city(events_id: Column, user_id: Column) -> Column:
    c = F.concat(F.lit("N"), (user_id % CITY_CODES).cast("string"))
    return F.when(events_id % 10 == 0, F.concat(F.lit(" "), c, F.lit(" "))).otherwise(c)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def city_map(nation: DataFrame) -> DataFrame:
    """An alias N<key> for every nation; N0 and N1 collide on one canonical name."""
    k = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("N"), k.cast("string")).alias("raw_city_name"),
        F.when(k == 1, F.lit("NATION_0")).otherwise(F.col("n_name")).alias("canonical_city"),
    )


def breakpoints(spark: SparkSession) -> DataFrame:
    from haze.sources.seeds import default_breakpoints
    return default_breakpoints(spark)


# Pollutant ids by event_id % 11 (aliases and one unknown id).
POLLUTANT_IDS = ["PM2.5", "pm2_5", "PM10", "PM_10", "NO2", "SO2", "CO", "OZONE", "o3", "NH3"]
UNKNOWN_POLLUTANT = "XYZ"


def aqi_readings(events: DataFrame) -> DataFrame:
    """Long raw readings: integer epochs in s/ms/µs/ns, padded cities, bad values."""
    e, u = F.col("event_id"), F.col("user_id")
    us = _micros(F.col("ts"))
    return events.select(
        F.concat(F.lit("S"), e.cast("string")).alias("station_id"),
        F.concat(F.lit("ST_"), (u % 60).cast("string")).alias("station_name"),
        _city(e, u).alias("city"),
        F.concat(F.lit("R"), (u % 3).cast("string")).alias("state"),
        _pick(e % 11, POLLUTANT_IDS, UNKNOWN_POLLUTANT).alias("pollutant_id"),
        F.when(e % 37 == 0, F.lit(None).cast("double"))
        .when(e % 41 == 0, F.lit(-1.0))
        .otherwise(F.col("value") * 2.0).alias("pollutant_avg"),
        _pick(e % 4, [int_div(us, 1_000_000), int_div(us, 1000), us], us * 1000)
        .alias("reading_timestamp"),
        (us + 300_000_000).alias("fetched_at"),
    )


def weather_readings(events: DataFrame) -> DataFrame:
    """Raw weather, one row per event; fetched_at ties within an hour.

    Events with id % 4 = 3 carry no recorded_at, so staging's not-null filter
    drops them and some station-hours end up without weather.
    """
    e, u = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    return events.select(
        _city(e, u).alias("city"),
        F.when(e % 4 != 3, ts).alias("recorded_at"),
        (F.lit(10.0) + (e * 7 % 300) / 10.0).alias("temp_celsius"),
        F.lit(None).cast("double").alias("feels_like_celsius"),
        (e * 13 % 101).cast("double").alias("humidity_pct"),
        F.when(e % 17 == 0, F.lit(None).cast("double"))
        .otherwise((e * 3 % 120) / 10.0).alias("wind_speed_mps"),
        (e * 11 % 360).cast("double").alias("wind_direction_degrees"),
        F.col("event_type").alias("weather_condition"),
        _pick(e % 3, [(e % 50) / 10.0, F.lit(0.0)], F.lit(None).cast("double"))
        .alias("rainfall_1h_mm"),
        F.lit(None).cast("double").alias("visibility_meters"),
        (F.lit(1000.0) + e % 30).alias("pressure_hpa"),
        (F.date_trunc("HOUR", ts) + F.expr("INTERVAL 1 HOUR")).alias("fetched_at"),
    )


# avg_value spellings by event_id % 13 (NULL at position 2).
AVG_VALUE_TEXTS = ["NA", "", None, "1500", " 12.5 ", "1_000", "12d", "nan", "-3", "1e2"]


def aqi_payloads(events: DataFrame) -> DataFrame:
    """AQI API records as text fields, one per event, with every kind of defect."""
    e, u = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    c = F.concat(F.lit("N"), (u % CITY_CODES).cast("string"))
    last_update = _pick(
        e % 7,
        [F.date_format(ts, "dd-MM-yyyy HH:mm:ss"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
         F.lit("31/02/2024 00:00:00"), F.lit(" 6/3/2024 6:0:0 ")],
        F.date_format(ts, "dd/MM/yyyy HH:mm:ss"),
    )
    avg = _pick(e % 13, [F.lit(v).cast("string") for v in AVG_VALUE_TEXTS],
                (e % 500).cast("string"))
    return events.select(
        e.alias("record_id"),
        ts.alias("landed_at"),
        F.when(e % 19 == 0, F.lit(None).cast("string"))
        .when(e % 23 == 0, F.lit("  ")).otherwise(c).alias("city"),
        F.concat(F.lit("R"), (u % 3).cast("string")).alias("state"),
        F.when(e % 29 == 0, F.lit("")).otherwise(
            F.concat(F.lit("ST_"), (u % 60).cast("string"))).alias("station"),
        F.lit("PM10").alias("pollutant_id"),
        avg.alias("avg_value"),
        F.lit("1").alias("min_value"),
        F.when(e % 31 == 0, F.lit(None).cast("string")).otherwise(F.lit("9")).alias("max_value"),
        last_update.alias("last_update"),
    )


def weather_payloads(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested current-weather objects, one per event, typed like parsed JSON."""
    e, u = F.col("event_id"), F.col("user_id")
    c = F.concat(F.lit("N"), (u % CITY_CODES).cast("string"))
    null_d = F.lit(None).cast("double")
    return events.select(
        e.alias("record_id"),
        F.col("ts").cast("timestamp").alias("landed_at"),
        F.when(e % 17 == 0, F.lit(None).cast("string")).otherwise(c).alias("name"),
        F.when(e % 53 == 0, F.lit(None).cast("long"))
        .otherwise(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("dt"),
        F.lit(10000.0).alias("visibility"),
        F.struct(
            ((e * 7 % 900) / 10.0 - 20.0).alias("temp"),
            null_d.alias("feels_like"),
            F.when(e % 23 == 0, null_d).otherwise((e * 13 % 130).cast("double")).alias("humidity"),
            (F.lit(1000.0) + e % 30).alias("pressure"),
        ).alias("main"),
        F.struct(
            F.when(e % 19 == 0, null_d).otherwise(F.col("value") / 10.0).alias("speed"),
            (e * 11 % 360).cast("double").alias("deg"),
        ).alias("wind"),
        F.when(e % 3 == 2, F.lit(None).cast("struct<`1h`:double>"))
        .otherwise(F.struct(_pick(e % 3, [(e % 50) / 10.0], null_d).alias("1h"))).alias("rain"),
        F.when(e % 29 == 0, F.array().cast("array<struct<main:string>>"))
        .otherwise(F.array(F.struct(F.col("event_type").alias("main")))).alias("weather"),
        *keep,
    )


def archive_payloads(events: DataFrame) -> DataFrame:
    """Hourly archive payloads with parallel arrays of uneven length, one per event."""
    e = F.col("event_id")
    start = F.date_trunc("HOUR", F.col("ts").cast("timestamp"))
    n = (e % 4 + 1).cast("int")  # 1..4 hours

    def arr(length: Column, f) -> Column:
        # first ``length`` of f(0..3); slice keeps empty arrays empty
        return F.slice(F.transform(F.sequence(F.lit(0), F.lit(3)), f), 1, length)

    def hour(i: Column) -> Column:
        return F.date_format(F.timestamp_add("HOUR", i, start), "yyyy-MM-dd'T'HH:mm")

    return events.select(
        e.alias("record_id"),
        F.concat(F.lit("N"), (F.col("user_id") % CITY_CODES).cast("string")).alias("city"),
        F.struct(
            arr(n, hour).alias("time"),
            arr(n, lambda i: F.col("value") + i).alias("temperature_2m"),
            arr(n - (e % 2).cast("int"), lambda i: ((e + i) % 100).cast("double"))
            .alias("relativehumidity_2m"),
            arr(n - 1, lambda i: (e * 3 + i) % 40 / 2.0).alias("windspeed_10m"),
            arr((e % 3).cast("int"), lambda i: ((e + i) % 5) / 10.0).alias("precipitation"),
        ).alias("hourly"),
    )


# The value fields of archived records and the names they have there.
ARCHIVED_NAMES = {"avg_value": "pollutant_avg", "min_value": "pollutant_min", "max_value": "pollutant_max"}


def land_aqi_pages(events: DataFrame, path: str, files: int | None = None, archived: bool = False) -> None:
    """Write the AQI payloads as landed pages of at most 100 records (JSON
    Lines, one page per line; NULL fields are left out, i.e. keys absent).
    ``archived``: two of five records carry the value fields under their other
    names only. ``files`` asks for a number of files (tests)."""
    p = aqi_payloads(events)
    other = (F.col("record_id") % 5 < 2) & F.lit(archived)
    values = [F.when(~other, F.col(c)).alias(c) for c in ARCHIVED_NAMES]
    values += [F.when(other, F.col(c)).alias(n) for c, n in ARCHIVED_NAMES.items()]
    rec = F.struct(F.col("record_id").cast("string").alias("id"), "city", "state", "station",
                   "pollutant_id", *values, "last_update")
    pages = (p.groupBy(int_div("record_id", 100).alias("page"))
             .agg(F.collect_list(rec).alias("records")))
    (pages.repartition(files) if files else pages).write.mode("overwrite").json(path)


def land_weather_objects(events: DataFrame, path: str, files: int | None = None) -> None:
    """Write the weather payloads as landed objects (JSON Lines)."""
    objects = weather_payloads(events).drop("record_id", "landed_at")
    (objects.repartition(files) if files else objects).write.mode("overwrite").json(path)


def land_requested_weather(events: DataFrame, path: str) -> None:
    """Landed weather objects, the files of each requested city in a folder of its own; adaptive
    execution gives a large city several tasks and files."""
    city = F.concat(F.lit("N"), (F.col("user_id") % CITY_CODES).cast("string"))
    objects = weather_payloads(events.withColumn("requested", city), keep=("requested",)).drop("record_id", "landed_at")
    objects.hint("rebalance", "requested").write.mode("overwrite").partitionBy("requested").json(path)


def request_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, city): the request that landed each file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("path"))
    return files.select("path", F.regexp_extract("path", "requested=([^/]+)/", 1).alias("city"))
