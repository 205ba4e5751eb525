"""Data-quality: run metrics, pipeline health, row-level checks, source freshness.

A check is a predicate that marks failing rows; a check fails when any row
fails. All checks on one model are evaluated in a single aggregation (one
scan, one partial aggregate per task, one tiny shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haze import schemas
from haze.functions.exprs import whole_units_between
from haze.session import ensure_utc

# Metric thresholds.
LOW_VOLUME_ROWS = 50
HIGH_QUARANTINE_ROWS = 10
PM25_MISSING_RATE = 0.3
# Freshness thresholds (hours) for loaded-at timestamps.
FRESHNESS_WARN_HOURS, FRESHNESS_ERROR_HOURS = 2, 6
FUTURE_TOLERANCE_HOURS = 6
METRICS_MAX_AGE_HOURS = 2


def _as_of(as_of: str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def _hours_before(ts: Column, n: int) -> Column:
    return ts - F.make_interval(hours=F.lit(n))


def _since(df: DataFrame, t: str, since: Column) -> DataFrame:
    """Rows from ``since`` on; a date partition column of the table prunes files first."""
    for part in (f"{t}_date", t.replace("_hour", "_date")):
        if part in df.columns and part != t:
            df = df.where(F.col(part) >= F.to_date(since))
    return df.where(F.col(t).cast("timestamp") >= since)


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """One row from one-row aggregates that each know some of the columns."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    return u.agg(*(F.max(n).alias(n) for n in names))


def quality_metrics(stg: DataFrame, wx: DataFrame, invalid: DataFrame,
                    as_of: str | Column | None = None, test_failures: Column | int = 0) -> DataFrame:
    """One row: recent row counts per source, pm25/pm10 NULL rates of the last
    hour, minutes since the latest AQI fetch, and alarm flags.

    Each source is filtered to the last hour before it is aggregated, so the
    filter reaches the scan (and its date partitions); only the newest fetch
    reads one column of all rows.
    """
    ensure_utc(stg.sparkSession)
    now = _as_of(as_of)
    since = _hours_before(now, 1)
    n = F.count(F.lit(1))
    m = _one_row([
        _since(stg, "reading_hour", since).agg(
            n.alias("aqi_rows_last_hour"), F.count_if(F.col("pm25").isNull()).alias("_no25"),
            F.count_if(F.col("pm10").isNull()).alias("_no10")),
        _since(wx, "weather_hour", since).agg(n.alias("weather_rows_last_hour")),
        _since(invalid, "quarantined_at", since).agg(n.alias("quarantine_rows_last_hour")),
        stg.agg(F.max(F.col("latest_fetched_at").cast("timestamp")).alias("_last_fetch")),
    ], ["aqi_rows_last_hour", "weather_rows_last_hour", "quarantine_rows_last_hour", "_no25", "_no10", "_last_fetch"])
    return _metrics_row(m, now, test_failures)


def _metrics_row(m: DataFrame, now: Column, test_failures: Column | int) -> DataFrame:
    """Rates, age and alarm flags of the counted metrics."""
    m = m.withColumns({"null_pm25_rate": F.try_divide("_no25", "aqi_rows_last_hour"),
                       "null_pm10_rate": F.try_divide("_no10", "aqi_rows_last_hour")})
    failures = test_failures if isinstance(test_failures, Column) else F.lit(test_failures)
    return m.select(
        now.alias("run_timestamp"),
        "aqi_rows_last_hour", "weather_rows_last_hour", "quarantine_rows_last_hour",
        "null_pm25_rate", "null_pm10_rate",
        F.coalesce(whole_units_between("MINUTE", F.col("_last_fetch"), now), F.lit(0))
        .cast("long").alias("freshness_minutes"),
        failures.cast("long").alias("test_failures"),
        (F.col("aqi_rows_last_hour") < LOW_VOLUME_ROWS).alias("is_aqi_low_volume"),
        (F.col("quarantine_rows_last_hour") > HIGH_QUARANTINE_ROWS).alias("is_high_quarantine_rate"),
        (F.col("null_pm25_rate") > PM25_MISSING_RATE).alias("is_pm25_data_missing"),
    )


def pipeline_health(stg: DataFrame, wx: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """One row: rows of the last 24 h per source and the latest fetch times."""
    ensure_utc(stg.sparkSession)
    now = _as_of(as_of)
    since = _hours_before(now, 24)
    n = F.count(F.lit(1))
    return _one_row([
        _since(stg, "reading_hour", since).agg(n.alias("aqi_rows_last_24h")),
        _since(wx, "weather_hour", since).agg(n.alias("weather_rows_last_24h")),
        stg.agg(F.max(F.col("latest_fetched_at").cast("timestamp")).alias("last_aqi_fetch")),
        wx.agg(F.max(F.col("fetched_at").cast("timestamp")).alias("last_weather_fetch")),
    ], ["aqi_rows_last_24h", "weather_rows_last_24h", "last_aqi_fetch", "last_weather_fetch"]).select(
        now.alias("run_timestamp"), "aqi_rows_last_24h", "weather_rows_last_24h", "last_aqi_fetch", "last_weather_fetch")


# ---------------------------------------------------------------- checks

def not_null(col: str) -> Column:
    return F.col(col).isNull()


def accepted_values(col: str, values: list[str]) -> Column:
    """Fails on values outside the list; NULL passes (NOT IN yields NULL)."""
    return ~F.col(col).isin(*values)


def run_checks(model: str, df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows (model, test_name, failures, status): every check in one scan."""
    counts = df.agg(*[F.count_if(pred).alias(f"_c{i}") for i, pred in enumerate(checks.values())])
    stack = F.inline(F.array(*[
        F.struct(F.lit(name).alias("test_name"), F.col(f"_c{i}").cast("long").alias("failures"))
        for i, name in enumerate(checks)]))
    return counts.select(F.lit(model).alias("model"), stack).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def staging_checks(stg: DataFrame) -> DataFrame:
    return run_checks("stg_readings", stg, {
        f"not_null_{c}": not_null(c) for c in ("station_name", "canonical_city", "reading_hour")})


def weather_checks(wx: DataFrame) -> DataFrame:
    return run_checks("stg_weather", wx, {
        f"not_null_{c}": not_null(c) for c in ("canonical_city", "weather_hour")})


def category_checks(cat: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """not_null + accepted category + non-negative composite + no future hours."""
    ensure_utc(cat.sparkSession)
    now = _as_of(as_of)
    return run_checks("with_category", cat, {
        "not_null_reading_hour": not_null("reading_hour"),
        "not_null_composite_aqi": not_null("composite_aqi"),
        "valid_aqi_category": accepted_values("aqi_category", schemas.CATEGORIES),
        "aqi_positive": F.col("composite_aqi") < 0,
        "no_future_timestamps": F.col("reading_hour") > now + F.make_interval(
            hours=F.lit(FUTURE_TOLERANCE_HOURS)),
    })


def joined_checks(joined: DataFrame) -> DataFrame:
    return run_checks("join_weather", joined, {
        f"not_null_{c}": not_null(c) for c in ("reading_hour", "canonical_city")})


def metrics_fresh_check(metrics: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Fails when the newest metrics row is too old, or there is none."""
    ensure_utc(metrics.sparkSession)
    now = _as_of(as_of)
    newest = metrics.agg(F.max("run_timestamp").alias("newest"))
    return run_checks("quality_metrics", newest, {
        "quality_metrics_fresh": F.coalesce(F.col("newest") < _hours_before(now, METRICS_MAX_AGE_HOURS), F.lit(True))})


def all_checks(stg: DataFrame, wx: DataFrame, cat: DataFrame, joined: DataFrame,
               as_of: str | Column | None = None) -> DataFrame:
    """The whole test report (one row per test)."""
    return (staging_checks(stg).unionByName(weather_checks(wx))
            .unionByName(category_checks(cat, as_of)).unionByName(joined_checks(joined)))


def check(name: str, failing_rows: DataFrame) -> DataFrame:
    """A singular test: ``failing_rows`` is the query of rows that violate it.
    One row (test_name, failures, status)."""
    return failing_rows.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("test_name"), "failures",
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def source_freshness(sources: Mapping[str, tuple],
                     as_of: str | Column | None = None,
                     warn_hours: int | None = FRESHNESS_WARN_HOURS,
                     error_hours: int | None = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Rows (source_name, max_loaded_at, age_minutes, status).

    ``sources`` maps a name to ``(df, loaded_at_col)`` or
    ``(df, loaded_at_col, warn_hours, error_hours)``; status is error / warn /
    pass by the age of the newest value, or ``not checked`` for a source whose
    thresholds are both None (a load field without a freshness rule).
    """
    ensure_utc(next(iter(sources.values()))[0].sparkSession)
    now = _as_of(as_of)
    parts = []
    for name, spec in sources.items():
        df, col = spec[0], spec[1]
        warn, err = (spec[2], spec[3]) if len(spec) == 4 else (warn_hours, error_hours)
        parts.append(df.select(
            F.lit(name).alias("source_name"), F.col(col).cast("timestamp").alias("_l"),
            F.lit(warn).cast("int").alias("_warn"), F.lit(err).cast("int").alias("_err")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    latest = u.groupBy("source_name").agg(
        F.max("_l").alias("max_loaded_at"), F.max("_warn").alias("_warn"), F.max("_err").alias("_err"))
    age = whole_units_between("MINUTE", F.col("max_loaded_at"), now)
    older = lambda h: F.col("max_loaded_at") < now - F.make_interval(hours=h)
    return latest.select(
        "source_name", "max_loaded_at", age.cast("long").alias("age_minutes"),
        F.when(F.col("_warn").isNull() & F.col("_err").isNull(), "not checked")
        .when(F.col("max_loaded_at").isNull(), "error")
        .when(F.col("_err").isNotNull() & older(F.col("_err")), "error")
        .when(F.col("_warn").isNotNull() & older(F.col("_warn")), "warn")
        .otherwise("pass").alias("status"))


def coverage_metrics(cat: DataFrame) -> DataFrame:
    """One row: rows whose composite has no category (between integer ranges
    or above the top one) and rows with no recognized pollutant (composite 0)."""
    none_present = F.lit(True)
    for c in schemas.POLLUTANT_COLUMNS:
        none_present = none_present & F.col(c).isNull()
    return cat.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("aqi_category").isNull()).alias("uncategorized_rows"),
        F.count_if(none_present).alias("no_pollutant_rows"),
    )


# ---------------------------------------------------------------- statistics kept by the writers

def readings_stats(stg: DataFrame) -> DataFrame:
    """Per reading hour: what the metrics, health and future-hour checks need of its rows."""
    return stg.groupBy(F.col("reading_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("pm25").isNull()).alias("no_pm25"),
        F.count_if(F.col("pm10").isNull()).alias("no_pm10"), F.max(F.col("latest_fetched_at").cast("timestamp")).alias("newest_fetch"))


def weather_stats(wx: DataFrame) -> DataFrame:
    return wx.groupBy(F.col("weather_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("fetched_at").cast("timestamp")).alias("newest_fetch"))


def invalid_stats(invalid: DataFrame) -> DataFrame:
    """Rows for each quarantine stamp (a load has one)."""
    return invalid.groupBy("source", "quarantined_at").agg(F.count(F.lit(1)).alias("rows"))


def daily_checks(stg: DataFrame, wx: DataFrame, cat: DataFrame, joined: DataFrame) -> DataFrame:
    """(model, test_name, failures, day): every check whose rows belong to one date."""
    parts = []
    for model, df, day, checks in (
            ("stg_readings", stg, "reading_date", {f"not_null_{c}": not_null(c) for c in ("station_name", "canonical_city", "reading_hour")}),
            ("stg_weather", wx, F.to_date("weather_hour"), {f"not_null_{c}": not_null(c) for c in ("canonical_city", "weather_hour")}),
            ("with_category", cat, "reading_date", {
                "not_null_reading_hour": not_null("reading_hour"), "not_null_composite_aqi": not_null("composite_aqi"),
                "valid_aqi_category": accepted_values("aqi_category", schemas.CATEGORIES), "aqi_positive": F.col("composite_aqi") < 0}),
            ("join_weather", joined, "reading_date", {f"not_null_{c}": not_null(c) for c in ("reading_hour", "canonical_city")})):
        counts = df.groupBy((F.col(day) if isinstance(day, str) else day).alias("day")).agg(
            *(F.count_if(p).alias(f"_c{i}") for i, p in enumerate(checks.values())))
        parts.append(counts.select(F.lit(model).alias("model"), F.inline(F.array(*(
            F.struct(F.lit(name).alias("test_name"), F.col(f"_c{i}").alias("failures")) for i, name in enumerate(checks)))), "day"))
    for p in parts[1:]:
        parts[0] = parts[0].unionByName(p)
    return parts[0]


def report_from_stats(checks: DataFrame, readings: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """The test report of ``all_checks`` from daily counts and hourly statistics."""
    late = F.col("hour") > _as_of(as_of) + F.make_interval(hours=F.lit(FUTURE_TOLERANCE_HOURS))
    future = readings.agg(F.coalesce(F.sum(F.when(late, F.col("rows"))), F.lit(0)).alias("failures")).select(
        F.lit("with_category").alias("model"), F.lit("no_future_timestamps").alias("test_name"), "failures")
    counted = checks.groupBy("model", "test_name").agg(F.sum("failures").alias("failures")).unionByName(future)
    return counted.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def metrics_from_stats(readings: DataFrame, weather: DataFrame, invalid: DataFrame,
                       as_of: str | Column | None = None, test_failures: Column | int = 0) -> DataFrame:
    """``quality_metrics`` from the statistics tables alone."""
    now = _as_of(as_of)
    since = _hours_before(now, 1)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    recent = lambda df, t: df.where(F.col(t) >= since)
    m = _one_row([
        recent(readings, "hour").agg(total("rows").alias("aqi_rows_last_hour"), total("no_pm25").alias("_no25"), total("no_pm10").alias("_no10")),
        recent(weather, "hour").agg(total("rows").alias("weather_rows_last_hour")),
        recent(invalid, "quarantined_at").agg(total("rows").alias("quarantine_rows_last_hour")),
        readings.agg(F.max("newest_fetch").alias("_last_fetch")),
    ], ["aqi_rows_last_hour", "weather_rows_last_hour", "quarantine_rows_last_hour", "_no25", "_no10", "_last_fetch"])
    return _metrics_row(m, now, test_failures)


def health_from_stats(readings: DataFrame, weather: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """``pipeline_health`` from the statistics tables alone."""
    now = _as_of(as_of)
    recent = F.col("hour") >= _hours_before(now, 24)
    rows = lambda df, kind: df.agg(F.coalesce(F.sum(F.when(recent, F.col("rows"))), F.lit(0)).alias(f"{kind}_rows_last_24h"),
                                   F.max("newest_fetch").alias(f"last_{kind}_fetch"))
    names = ["aqi_rows_last_24h", "weather_rows_last_24h", "last_aqi_fetch", "last_weather_fetch"]
    return _one_row([rows(readings, "aqi"), rows(weather, "weather")], names).select(now.alias("run_timestamp"), *names)
