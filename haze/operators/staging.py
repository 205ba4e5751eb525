"""Staging: typed, city-normalized, hour-bucketed readings.

``stg_readings``  long raw readings -> one wide row per station x city x state x hour
``stg_weather``   raw weather -> one row per city x hour (latest fetch wins)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haze import schemas
from haze.functions.exprs import strip_ws, to_instant, wind_category
from haze.functions.joins import fits_broadcast
from haze.session import ensure_utc

READING_KEYS = ["station_name", "canonical_city", "state", "reading_hour", "reading_date"]

WEATHER_MEASURES = [
    "temp_celsius", "feels_like_celsius", "humidity_pct", "wind_speed_mps",
    "wind_direction_degrees", "weather_condition", "rainfall_1h_mm",
    "visibility_meters", "pressure_hpa",
]


def canonicalize_city(df: DataFrame, city_map: DataFrame, city_col: str = "city") -> DataFrame:
    """Left join to the alias table on the trimmed name; unmapped names are kept as-is.

    Trimming removes any leading/trailing white space; the match is exact
    (case-sensitive) and the kept name is the untrimmed original. The alias table is broadcast only after its size is checked.
    """
    cm = city_map.select(
        F.col("raw_city_name").alias("_raw_city"), F.col("canonical_city").alias("_canon_city"))
    if fits_broadcast(city_map):
        cm = F.broadcast(cm)
    joined = df.join(cm, strip_ws(df[city_col]) == cm["_raw_city"], "left")
    return joined.withColumn("canonical_city", F.coalesce(F.col("_canon_city"), df[city_col])) \
        .drop("_raw_city", "_canon_city")


def stg_readings(raw: DataFrame, city_map: DataFrame) -> DataFrame:
    """Filter, decode epochs, normalize city, bucket to the hour and pivot pollutants.

    Keeps rows with a positive (non-NaN) average and a reading time. The pivot
    is a conditional MAX per pollutant over case-insensitive id aliases, so a
    reading with an unknown id still yields its (all-NULL) wide row. One
    aggregation: partial max per map task, one shuffle on the five keys.
    """
    ensure_utc(raw.sparkSession)
    ts_type = raw.schema["reading_timestamp"].dataType
    fetched_type = raw.schema["fetched_at"].dataType
    avg = F.col("pollutant_avg")
    typed = raw.where(
        avg.isNotNull() & (avg > 0) & ~F.isnan(avg) & F.col("reading_timestamp").isNotNull()
    ).select(
        "station_name", "city", "state", "pollutant_id", "pollutant_avg",
        to_instant("reading_timestamp", ts_type).alias("reading_timestamp"),
        to_instant("fetched_at", fetched_type).alias("fetched_at"),
    )
    hour = F.date_trunc("HOUR", F.col("reading_timestamp"))
    norm = canonicalize_city(typed, city_map).select(
        "station_name", "canonical_city", "state",
        hour.alias("reading_hour"), F.to_date(hour).alias("reading_date"),
        F.upper("pollutant_id").alias("_pid"), "pollutant_avg", "fetched_at",
    )
    pivots = [F.max(F.when(F.col("_pid").isin(*aliases), avg)).alias(col)
              for col, _, aliases in schemas.POLLUTANTS]
    return norm.groupBy(*READING_KEYS).agg(*pivots, F.max("fetched_at").alias("latest_fetched_at"))


def stg_weather(raw: DataFrame, city_map: DataFrame) -> DataFrame:
    """Normalize city, bucket to the hour and keep the latest fetch per city-hour.

    Ties on ``fetched_at`` are broken by ``recorded_at`` (latest first) and then
    by the measures, so the kept row is deterministic. ``row_number() = 1`` is
    planned as a partial per-task group limit before the shuffle, so even a
    city-hour holding a large share of the rows shuffles one row per task.
    """
    ensure_utc(raw.sparkSession)
    rec_type = raw.schema["recorded_at"].dataType
    rec = to_instant("recorded_at", rec_type)
    norm = canonicalize_city(raw.where(F.col("recorded_at").isNotNull()), city_map).select(
        "canonical_city",
        F.date_trunc("HOUR", rec).alias("weather_hour"),
        rec.alias("_recorded_at"),
        *[c for c in WEATHER_MEASURES if c != "rainfall_1h_mm"],
        F.coalesce(F.col("rainfall_1h_mm"), F.lit(0.0)).alias("rainfall_1h_mm"),
        to_instant("fetched_at", raw.schema["fetched_at"].dataType).alias("fetched_at"),
    )
    order = [F.col("fetched_at").desc_nulls_last(), F.col("_recorded_at").desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in WEATHER_MEASURES]
    w = Window.partitionBy("canonical_city", "weather_hour").orderBy(*order)
    latest = norm.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return latest.select(
        "canonical_city", "weather_hour",
        *WEATHER_MEASURES,
        (F.col("rainfall_1h_mm") > 0).alias("is_raining"),
        wind_category("wind_speed_mps").alias("wind_category"),
        "fetched_at",
    )
