"""Fixed schemas. Nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One AQI API record. Every leaf is read as text: the API sends numbers both as
# JSON numbers and as strings, and Spark's JSON reader returns the literal text
# of either when the field is declared as a string.
AQI_RECORD = _struct(
    ("id", S), ("country", S), ("state", S), ("city", S), ("station", S),
    ("last_update", S), ("latitude", S), ("longitude", S), ("pollutant_id", S),
    ("avg_value", S), ("min_value", S), ("max_value", S),
    ("pollutant_avg", S), ("pollutant_min", S), ("pollutant_max", S),
    ("pollutant_unit", S),
)

# A landed page: {"records": [ ... ]}. Records stay raw JSON text so the
# quarantine keeps the untouched payload; they are parsed with AQI_RECORD.
AQI_PAGE = _struct(("records", T.ArrayType(S)), ("_corrupt_record", S))

# One current-weather API object (nested), leaves as text for the same reason.
WEATHER_RECORD = _struct(
    ("name", S), ("dt", S), ("visibility", S),
    ("main", _struct(("temp", S), ("feels_like", S), ("humidity", S), ("pressure", S))),
    ("wind", _struct(("speed", S), ("deg", S))),
    ("rain", _struct(("1h", S))),
    ("weather", T.ArrayType(_struct(("main", S)))),
    ("_corrupt_record", S),
)

# Historical weather archive payload: parallel hourly arrays.
WEATHER_ARCHIVE = _struct(
    ("city", S),
    ("hourly", _struct(
        ("time", T.ArrayType(S)),
        ("temperature_2m", T.ArrayType(D)),
        ("relativehumidity_2m", T.ArrayType(D)),
        ("windspeed_10m", T.ArrayType(D)),
        ("precipitation", T.ArrayType(D)),
    )),
)

CITIES = _struct(("city", S), ("lat", D), ("lon", D))
CITY_MAP = _struct(("raw_city_name", S), ("canonical_city", S))
BREAKPOINTS = T.StructType([
    T.StructField("min_aqi", T.IntegerType(), True),
    T.StructField("max_aqi", T.IntegerType(), True),
    T.StructField("category", S, True),
    T.StructField("health_message", S, True),
])

# Raw (append-only) tables.
AQI_READINGS = _struct(
    ("station_id", S), ("station_name", S), ("city", S), ("state", S),
    ("pollutant_id", S), ("pollutant_avg", D), ("pollutant_min", D),
    ("pollutant_max", D), ("pollutant_unit", S),
    ("reading_timestamp", TS), ("fetched_at", TS),
)

WEATHER_READINGS = _struct(
    ("city", S), ("recorded_at", TS), ("temp_celsius", D), ("feels_like_celsius", D),
    ("humidity_pct", D), ("wind_speed_mps", D), ("wind_direction_degrees", D),
    ("weather_condition", S), ("rainfall_1h_mm", D), ("visibility_meters", D),
    ("pressure_hpa", D), ("fetched_at", TS),
)

INVALID_RECORDS = _struct(
    ("source", S), ("error_reason", S), ("error_field", S),
    ("raw_payload", S), ("quarantined_at", TS),
)

# The pollutant columns of the wide table, in the order used to
# break ties when naming the dominant pollutant, with the upper-cased ids that
# map to each column.
POLLUTANTS = [
    ("pm25", "PM2.5", ["PM2.5", "PM2_5", "PM2.5 "]),
    ("pm10", "PM10", ["PM10", "PM_10"]),
    ("no2", "NO2", ["NO2"]),
    ("so2", "SO2", ["SO2"]),
    ("co", "CO", ["CO"]),
    ("ozone", "OZONE", ["OZONE", "O3"]),
    ("nh3", "NH3", ["NH3"]),
]
POLLUTANT_COLUMNS = [c for c, _, _ in POLLUTANTS]

# The accepted category labels.
CATEGORIES = ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]
