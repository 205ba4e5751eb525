"""Intermediate models: composite index + category, then hourly weather enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haze import schemas
from haze.functions.exprs import composite_index
from haze.functions.joins import fits_broadcast, range_lookup
from haze.operators.staging import READING_KEYS

CATEGORY_COLUMNS = READING_KEYS + schemas.POLLUTANT_COLUMNS + [
    "composite_aqi", "aqi_category", "health_message"]

JOINED_COLUMNS = [
    "station_name", "canonical_city", "state", "reading_hour", "reading_date",
    "composite_aqi", "aqi_category", *schemas.POLLUTANT_COLUMNS,
    "temp_celsius", "feels_like_celsius", "humidity_pct", "wind_speed_mps",
    "wind_direction_degrees", "weather_condition", "rainfall_1h_mm", "is_raining",
    "wind_category", "visibility_meters", "pressure_hpa", "weather_fetched_at",
    "has_weather_data",
]


def with_category(stg: DataFrame, breakpoints: DataFrame,
                  bucket_width: float = 50.0) -> DataFrame:
    """Composite index (row max, NULL as 0) and its category by inclusive range.

    A value between two integer ranges (50.5) or above the last one gets a
    NULL category. The range table is broadcast after a size check (the build
    side is always the range table); a large one is joined on value buckets.
    """
    calc = stg.select(*READING_KEYS, *schemas.POLLUTANT_COLUMNS,
                      composite_index(schemas.POLLUTANT_COLUMNS).alias("composite_aqi"))
    bp = breakpoints.select("min_aqi", "max_aqi", F.col("category").alias("aqi_category"),
                            "health_message")
    out = range_lookup(calc, calc["composite_aqi"], bp, "min_aqi", "max_aqi", "left",
                       bucket_width=bucket_width, small=fits_broadcast(breakpoints))
    return out.select(*CATEGORY_COLUMNS)


def join_weather(cat: DataFrame, wx: DataFrame) -> DataFrame:
    """Left join station-hours to the city-hour weather (unique per key: no fan-out).

    Both sides are hash-partitioned on (city, hour); the weather side already
    is after its dedup window, so only the readings shuffle. AQE may turn it
    into a broadcast join when the weather side is measured small, and splits
    skewed city-hours of the preserved side.
    """
    w = wx.select(
        F.col("canonical_city").alias("_w_city"), F.col("weather_hour").alias("_w_hour"),
        "temp_celsius", "feels_like_celsius", "humidity_pct", "wind_speed_mps",
        "wind_direction_degrees", "weather_condition", "rainfall_1h_mm", "is_raining",
        "wind_category", "visibility_meters", "pressure_hpa",
        F.col("fetched_at").alias("weather_fetched_at"),
    )
    j = cat.join(w, (cat["canonical_city"] == w["_w_city"]) & (cat["reading_hour"] == w["_w_hour"]),
                 "left")
    return j.withColumn("has_weather_data", F.col("_w_city").isNotNull()).select(*JOINED_COLUMNS)
