"""Record validation, quarantine envelopes and normalization of API records.

Each rule is a Column predicate; the first failing rule in order becomes the
row's ``(error_field, error_reason)``. A failing record never fails the batch:
one pass tags every row and the good and bad rows are two filters of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haze.functions.exprs import as_double, parse_local_datetime, safe_double, strip_ws
from haze.session import ensure_utc

# Required AQI record fields, in the order they are checked.
AQI_REQUIRED = ["city", "state", "station", "pollutant_id", "avg_value",
                "min_value", "max_value", "last_update"]
# Accepted range of the average value (inclusive).
AVG_RANGE = (0.0, 1000.0)
# Required weather paths in check order, and value ranges.
WEATHER_REQUIRED = ["name", "dt", "main.temp", "main.humidity", "wind.speed", "weather[0].main"]
TEMP_RANGE = (-10.0, 60.0)
HUMIDITY_RANGE = (0.0, 100.0)

MISSING, NOT_NUMERIC, OUT_OF_RANGE = "missing", "not numeric", "out of range"
BAD_DATETIME, EMPTY, UNKNOWN = "bad datetime format", "empty", "unknown"


def _rule(cond: Column, field: str, reason: str | Column) -> Column:
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.when(cond, F.struct(F.lit(field).alias("field"), reason.alias("reason")))


def _outside(x: Column, lo: float, hi: float) -> Column:
    """x < lo or x > hi, where NaN is inside (every NaN comparison is false)."""
    return ~F.isnan(x) & ((x < lo) | (x > hi))


def _field(df: DataFrame, path: str) -> tuple[Column, T.DataType]:
    """Column and type at a dotted path; ``weather[0].main`` reads the first
    array element (NULL when the array is empty or missing)."""
    if path == "weather[0].main":
        return F.get(F.col("weather"), 0)["main"], T.StringType()
    dtype: T.DataType = df.schema
    for part in path.split("."):
        dtype = dtype[part].dataType  # type: ignore[index]
    return F.col(path), dtype


def _with_error(df: DataFrame, rules: list[Column]) -> DataFrame:
    err = F.coalesce(*rules)
    return df.withColumn("_error", err).select(
        "*", F.col("_error.field").alias("error_field"),
        F.col("_error.reason").alias("error_reason")).drop("_error")


# Value fields and the alternative names the API may use instead.
FALLBACK_FIELDS = {"avg_value": "pollutant_avg", "min_value": "pollutant_min",
                   "max_value": "pollutant_max"}


def validate_readings(df: DataFrame, fallback_first: bool = False) -> DataFrame:
    """Tag AQI records (text columns named as the API fields) with the first
    failing rule: missing field, non-numeric or out-of-range average, bad
    datetime, blank city or station. Valid rows have NULL error columns.

    By default the value fields are checked under their primary names only, so
    a record carrying only ``pollutant_*`` names fails as missing (as the
    source does). ``fallback_first=True`` resolves each value field to its
    alternative name first (when the primary key is absent) and validates that.
    """
    ensure_utc(df.sparkSession)
    if fallback_first:
        df = df.withColumns({name: _present_or_fallback(df, name, alt)
                             for name, alt in FALLBACK_FIELDS.items()})
    return _with_error(df, _reading_rules(df, safe_double("avg_value"), parse_local_datetime("last_update")))


def _reading_rules(df: DataFrame, avg: Column, at: Column) -> list[Column]:
    """The rules of an AQI record, given its parsed average and reading time."""
    rules = []
    if "_unknown" in df.columns:  # unreadable record (see sources.landing.aqi_records)
        rules.append(_rule(F.col("_unknown").isNotNull(), UNKNOWN, F.col("_unknown")))
    rules += [_rule(F.col(f).isNull(), f, MISSING) for f in AQI_REQUIRED]
    rules += [
        _rule(avg.isNull(), "avg_value", NOT_NUMERIC),
        _rule(_outside(avg, *AVG_RANGE), "avg_value", OUT_OF_RANGE),
        _rule(at.isNull(), "last_update", BAD_DATETIME),
        _rule(strip_ws("city") == "", "city", EMPTY),
        _rule(strip_ws("station") == "", "station", EMPTY),
    ]
    return rules


def _present_or_fallback(df: DataFrame, name: str, fallback: str) -> Column:
    """``record.get(name, record.get(fallback))``: the fallback applies only when
    the key is absent (per-row key list ``_keys`` when read from JSON)."""
    has_name, has_fb = name in df.columns, fallback in df.columns
    if "_keys" in df.columns and has_name and has_fb:
        present = F.col(name).isNotNull() | F.coalesce(F.array_contains("_keys", name), F.lit(False))
        return F.when(present, F.col(name)).otherwise(F.col(fallback))
    if has_name:
        return F.col(name)
    return F.col(fallback) if has_fb else F.lit(None).cast("string")


def _opt(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_readings(df: DataFrame, fetched_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """AQI record -> raw reading row (``avg_value`` else ``pollutant_avg``, etc.);
    ``keep`` columns are passed through in front."""
    ensure_utc(df.sparkSession)
    return df.select(
        *keep,
        _opt(df, "id").alias("station_id"),
        _opt(df, "station").alias("station_name"),
        "city", "state", "pollutant_id",
        safe_double(_present_or_fallback(df, "avg_value", "pollutant_avg")).alias("pollutant_avg"),
        safe_double(_present_or_fallback(df, "min_value", "pollutant_min")).alias("pollutant_min"),
        safe_double(_present_or_fallback(df, "max_value", "pollutant_max")).alias("pollutant_max"),
        _opt(df, "pollutant_unit").alias("pollutant_unit"),
        parse_local_datetime("last_update").alias("reading_timestamp"),
        fetched_at.cast("timestamp").alias("fetched_at"),
    )


def _dt_seconds(c: Column, dtype: T.DataType) -> Column:
    """``int(dt)``: an integral value, or any finite number truncated (a JSON
    number such as 1.7E9 arrives as text); else NULL."""
    if isinstance(dtype, T.NumericType):
        return c.cast("double").cast("long")
    s = strip_ws(c)
    d = safe_double(s)
    return (F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("long"))
            .when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.cast("long")))


def validate_weather(df: DataFrame) -> DataFrame:
    """Tag nested weather objects: required paths, temperature -10..60 and
    humidity 0..100 (non-numeric counts as out of range), integral ``dt``."""
    return _with_error(df, _weather_rules(df, as_double(*_field(df, "main.temp")), as_double(*_field(df, "main.humidity")),
                                          _dt_seconds(*_field(df, "dt"))))


def _weather_rules(df: DataFrame, temp: Column, hum: Column, seconds: Column) -> list[Column]:
    """The rules of a weather object, given its parsed temperature, humidity and time."""
    rules = []
    if "_corrupt_record" in df.columns:
        # Only a document that is not a JSON object at all is unreadable; on a
        # type mismatch (e.g. "main" not an object) the reader keeps the other
        # fields and the path rules report the first unusable path.
        bad = F.col("_corrupt_record")
        rules.append(_rule(bad.isNotNull() & F.json_object_keys(bad).isNull(), UNKNOWN, "malformed JSON"))
    rules += [_rule(_field(df, p)[0].isNull(), p, MISSING) for p in WEATHER_REQUIRED]
    rules += [
        _rule(temp.isNull() | _outside(temp, *TEMP_RANGE), "main.temp", OUT_OF_RANGE),
        _rule(hum.isNull() | _outside(hum, *HUMIDITY_RANGE), "main.humidity", OUT_OF_RANGE),
        _rule(seconds.isNull(), UNKNOWN, "dt is not an integer"),
    ]
    return rules


def normalize_weather(df: DataFrame, fetched_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested weather object -> flat raw weather row; rain defaults to 0.0;
    ``keep`` columns are passed through in front."""
    def num(path: str) -> Column:
        try:
            return as_double(*_field(df, path))
        except (KeyError, IndexError):
            return F.lit(None).cast("double")

    rain = num("rain.1h") if "rain" in df.columns else F.lit(None).cast("double")
    return df.select(
        *keep,
        F.col("name").alias("city"),
        F.timestamp_seconds(_dt_seconds(*_field(df, "dt"))).alias("recorded_at"),
        num("main.temp").alias("temp_celsius"),
        num("main.feels_like").alias("feels_like_celsius"),
        num("main.humidity").alias("humidity_pct"),
        num("wind.speed").alias("wind_speed_mps"),
        num("wind.deg").alias("wind_direction_degrees"),
        _field(df, "weather[0].main")[0].alias("weather_condition"),
        F.coalesce(rain, F.lit(0.0)).alias("rainfall_1h_mm"),
        num("visibility").alias("visibility_meters"),
        num("main.pressure").alias("pressure_hpa"),
        fetched_at.cast("timestamp").alias("fetched_at"),
    )


def payload_json(df: DataFrame, fields: list[str]) -> Column:
    """JSON text of the record fields, NULLs kept as ``null``."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})


def quarantine_rows(checked: DataFrame, source: str, quarantined_at: Column,
                    payload: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope of the failing rows: (source, error_reason, error_field,
    raw_payload, quarantined_at). ``raw_payload`` defaults to the landed text
    when present, else the record re-encoded as JSON."""
    if payload is None:
        if "raw_payload" in checked.columns:
            payload = F.col("raw_payload")
        else:
            fields = [c for c in checked.columns
                      if c not in ("error_field", "error_reason", "record_id", "landed_at")
                      and not c.startswith("_")]
            payload = payload_json(checked, fields)
    return checked.where(F.col("error_field").isNotNull()).select(
        *keep, F.lit(source).alias("source"), "error_reason", "error_field",
        payload.alias("raw_payload"), quarantined_at.cast("timestamp").alias("quarantined_at"))


def weather_quarantine_payload() -> Column:
    """Weather quarantine keeps only the city and the error text."""
    return F.to_json(F.struct(F.col("name").alias("city"),
                              F.concat_ws(": ", "error_field", "error_reason").alias("error")),
                     {"ignoreNullFields": "false"})


# -- one pass for both outcomes

GOOD, BAD = "good", "bad"


def _routed(checked: DataFrame, good: dict[str, Column], source: str, payload: Column, stamp: Column) -> DataFrame:
    """One row for each record: ``outcome``, the raw table's columns (NULL for a bad record)
    and the quarantine envelope (NULL for a good one)."""
    bad = F.col("error_field").isNotNull()
    envelope = {"source": F.lit(source), "error_reason": F.col("error_reason"), "error_field": F.col("error_field"),
                "raw_payload": payload, "quarantined_at": stamp.cast("timestamp")}
    return checked.select(F.when(bad, BAD).otherwise(GOOD).alias("outcome"),
                          *(F.when(~bad, c).alias(name) for name, c in good.items()),
                          *(F.when(bad, c).alias(name) for name, c in envelope.items()))


def route_readings(records: DataFrame, run_ts: Column, fallback_first: bool = False) -> DataFrame:
    """AQI records -> typed raw readings and quarantine envelopes in one frame. Every number
    and time is parsed once, into a column that both the rules and the row use."""
    ensure_utc(records.sparkSession)
    if fallback_first:
        records = records.withColumns({name: _present_or_fallback(records, name, alt) for name, alt in FALLBACK_FIELDS.items()})
    typed = records.withColumns({"_avg": safe_double("avg_value"), "_min": safe_double("min_value"), "_max": safe_double("max_value"),
                                 "_at": parse_local_datetime("last_update")})
    checked = _with_error(typed, _reading_rules(typed, F.col("_avg"), F.col("_at")))
    good = {"station_id": _opt(records, "id"), "station_name": F.col("station"), "city": F.col("city"), "state": F.col("state"),
            "pollutant_id": F.col("pollutant_id"), "pollutant_avg": F.col("_avg"), "pollutant_min": F.col("_min"),
            "pollutant_max": F.col("_max"), "pollutant_unit": _opt(records, "pollutant_unit"), "reading_timestamp": F.col("_at"),
            "fetched_at": run_ts.cast("timestamp")}
    return _routed(checked, good, "aqi", F.col("raw_payload"), run_ts)


def route_weather(objects: DataFrame, run_ts: Column) -> DataFrame:
    """Weather objects -> typed raw weather and quarantine envelopes in one frame. The
    envelope names the requested city where the landing manifest has it, else ``name``."""
    paths = {"temp_celsius": "main.temp", "feels_like_celsius": "main.feels_like", "humidity_pct": "main.humidity",
             "wind_speed_mps": "wind.speed", "wind_direction_degrees": "wind.deg", "visibility_meters": "visibility",
             "pressure_hpa": "main.pressure", "_rain": "rain.1h"}
    typed = objects.withColumns({f"_{name}": as_double(*_field(objects, path)) for name, path in paths.items()}
                                | {"_seconds": _dt_seconds(*_field(objects, "dt"))})
    checked = _with_error(typed, _weather_rules(typed, F.col("_temp_celsius"), F.col("_humidity_pct"), F.col("_seconds")))
    number = lambda name: F.col(f"_{name}")
    good = {"city": F.col("name"), "recorded_at": F.timestamp_seconds(F.col("_seconds")), "temp_celsius": number("temp_celsius"),
            "feels_like_celsius": number("feels_like_celsius"), "humidity_pct": number("humidity_pct"), "wind_speed_mps": number("wind_speed_mps"),
            "wind_direction_degrees": number("wind_direction_degrees"), "weather_condition": _field(objects, "weather[0].main")[0],
            "rainfall_1h_mm": F.coalesce(number("_rain"), F.lit(0.0)), "visibility_meters": number("visibility_meters"),
            "pressure_hpa": number("pressure_hpa"), "fetched_at": run_ts.cast("timestamp")}
    city = F.coalesce("requested_city", "name") if "requested_city" in objects.columns else F.col("name")
    payload = F.to_json(F.struct(city.alias("city"), F.concat_ws(": ", "error_field", "error_reason").alias("error")),
                        {"ignoreNullFields": "false"})
    return _routed(checked, good, "weather", payload, run_ts)
