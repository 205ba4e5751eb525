"""Reference lookups (seeds): city aliases, category breakpoints, monitored cities.

They can be read from CSV/JSON files (``read_*``) or built from the packaged
fixed values below (``default_*``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haze import schemas

# Raw city spelling -> canonical city.
CITY_MAP_ROWS = [
    ("New Delhi", "Delhi"),
    ("Delhi", "Delhi"),
    ("Bangalore", "Bengaluru"),
    ("Bengaluru", "Bengaluru"),
    ("Bombay", "Mumbai"),
    ("Mumbai", "Mumbai"),
    ("Calcutta", "Kolkata"),
    ("Kolkata", "Kolkata"),
    ("Hyderabad", "Hyderabad"),
    ("Chennai", "Chennai"),
    ("Ahmedabad", "Ahmedabad"),
    ("Pune", "Pune"),
    ("Lucknow", "Lucknow"),
    ("Patna", "Patna"),
]

# AQI category breakpoints (inclusive integer bounds).
BREAKPOINT_ROWS = [
    (0, 50, "Good", "Minimal impact"),
    (51, 100, "Satisfactory", "Minor breathing discomfort"),
    (101, 200, "Moderate", "Breathing discomfort for sensitive groups"),
    (201, 300, "Poor", "Breathing discomfort for most people"),
    (301, 400, "Very Poor", "Respiratory illness on prolonged exposure"),
    (401, 500, "Severe", "Health impacts even on light activity"),
]

# Monitored cities with coordinates.
CITY_ROWS = [
    ("Delhi", 28.6139, 77.2090),
    ("Mumbai", 19.0760, 72.8777),
    ("Bengaluru", 12.9716, 77.5946),
    ("Chennai", 13.0827, 80.2707),
    ("Kolkata", 22.5726, 88.3639),
    ("Hyderabad", 17.3850, 78.4867),
    ("Ahmedabad", 23.0225, 72.5714),
    ("Pune", 18.5204, 73.8567),
    ("Lucknow", 26.8467, 80.9462),
    ("Patna", 25.5941, 85.1376),
]


def default_city_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_MAP_ROWS, schemas.CITY_MAP)


def default_breakpoints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BREAKPOINT_ROWS, schemas.BREAKPOINTS)


def default_cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITY_ROWS, schemas.CITIES)


def read_city_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CITY_MAP).option("header", True).csv(path)


def read_breakpoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.BREAKPOINTS).option("header", True).csv(path)


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of {city, lat, lon} (one document per file)."""
    return spark.read.schema(schemas.CITIES).option("multiLine", True).json(path)
