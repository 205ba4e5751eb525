"""One pipeline run: landed payloads -> raw tables -> models -> marts -> checks.

The stage order is plain Python; every stage is a distributed Spark job.
Tables read by more than one later stage (the two staging tables and the wide
readings x weather table, which feeds four marts) are written once
(date-partitioned, clustered by city) and read back. That also cuts the
lineage: a lost executor recomputes from those tables, not from the landing
files.

Layout under ``warehouse``::

    raw/aqi_readings        a folder per load (load_id=...): runs, backfilled days, stream batches
    raw/weather_readings    the same
    raw/invalid_records     the same, under source=...
    raw/loaded_files        landed files that a load has taken, under source=...
    stg/readings, stg/weather  overwrite, partitioned by date, clustered by city
    int/aqi_weather_joined  overwrite, partitioned by reading_date
    marts/<name>            overwrite (full refresh)
    quality/metrics, quality/health, quality/tests   a folder per run

A run that is repeated with the same stamp replaces what it wrote before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haze import schemas, sinks
from haze.operators import enrich, marts, quality, staging, validate
from haze.session import ensure_utc
from haze.sources import landing, seeds


T = TypeVar("T")


def _concurrently(tasks: dict[str, Callable[[], T]], workers: int) -> dict[str, T]:
    """Run independent Spark jobs from a few driver threads (as the source runs
    its two ingestions side by side and builds models with several threads);
    Spark schedules their tasks on the same executors."""
    if workers <= 1:
        return {name: task() for name, task in tasks.items()}
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = {name: pool.submit(task) for name, task in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class RunResult:
    loaded: dict[str, int] = field(default_factory=dict)
    failed_tests: int = 0


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def _stamp(run_ts: str | None) -> Column:
    """One run stamp for every row and table of a run (fixed on the driver)."""
    return F.lit(run_ts or _now()).cast("timestamp")


def load_name(run_ts: str) -> str:
    """Load id of a run: its stamp, digits only."""
    return "run-" + "".join(c for c in run_ts if c.isdigit())


def ingest_readings(spark: SparkSession, landing_path: str, warehouse: str,
                    run_ts: Column, load_id: str, multiline: bool = True) -> tuple[int, int]:
    """Landed AQI pages that no other run has loaded -> raw readings + quarantine of this load."""
    ledger = f"{warehouse}/raw/loaded_files/source=aqi"
    files = landing.unloaded_files(spark, landing_path, ledger, load_id)
    if not files:
        return 0, 0
    checked = validate.validate_readings(landing.aqi_records(landing.read_aqi_pages(spark, files, multiline))).persist()
    try:
        good = validate.normalize_readings(checked.where(F.col("error_field").isNull()), run_ts)
        n_good = sinks.write_load(good, f"{warehouse}/raw/aqi_readings", load_id)
        n_bad = sinks.write_quarantine(validate.quarantine_rows(checked, "aqi", run_ts),
                                       f"{warehouse}/raw/invalid_records", "aqi", load_id)
    finally:
        checked.unpersist()
    landing.mark_loaded(spark, files, ledger, load_id)
    return n_good, n_bad


def ingest_weather(spark: SparkSession, landing_path: str, warehouse: str,
                   run_ts: Column, load_id: str, multiline: bool = True) -> tuple[int, int]:
    """Landed weather objects that no other run has loaded -> raw weather + quarantine of this load."""
    ledger = f"{warehouse}/raw/loaded_files/source=weather"
    files = landing.unloaded_files(spark, landing_path, ledger, load_id)
    if not files:
        return 0, 0
    checked = validate.validate_weather(landing.read_weather_objects(spark, files, multiline)).persist()
    try:
        good = validate.normalize_weather(checked.where(F.col("error_field").isNull()), run_ts)
        n_good = sinks.write_load(good, f"{warehouse}/raw/weather_readings", load_id)
        bad = validate.quarantine_rows(checked, "weather", run_ts,
                                       payload=validate.weather_quarantine_payload())
        n_bad = sinks.write_quarantine(bad, f"{warehouse}/raw/invalid_records", "weather", load_id)
    finally:
        checked.unpersist()
    landing.mark_loaded(spark, files, ledger, load_id)
    return n_good, n_bad


def _read_back(spark: SparkSession, path: str, written: DataFrame) -> DataFrame:
    """Read a table this run wrote, with the schema it was written with (an
    empty table has no data files to infer a schema from)."""
    return spark.read.schema(written.schema).parquet(path)


def read_raw(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    schema = {"aqi_readings": schemas.AQI_READINGS, "weather_readings": schemas.WEATHER_READINGS,
              "invalid_records": schemas.INVALID_RECORDS}[name]
    return sinks.read_table(spark, f"{warehouse}/raw/{name}", schema).select(schema.fieldNames())


def build_models(spark: SparkSession, warehouse: str, city_map: DataFrame,
                 breakpoints: DataFrame, as_of: str | None = None, workers: int = 4,
                 load_id: str | None = None) -> RunResult:
    """Staging -> intermediate (materialized) -> marts -> quality tables."""
    out = RunResult()
    # Staging is read by the intermediate table, a mart, the checks and both
    # health tables: build each staging table once and read it back.
    stg_path, wx_path = f"{warehouse}/stg/readings", f"{warehouse}/stg/weather"
    stg_df = staging.stg_readings(read_raw(spark, warehouse, "aqi_readings"), city_map)
    wx_df = staging.stg_weather(read_raw(spark, warehouse, "weather_readings"), city_map)
    out.loaded.update(_concurrently({
        "stg_readings": lambda: sinks.write_table(
            stg_df, stg_path, "overwrite", partition_by=["reading_date"], cluster_by=["canonical_city"]),
        "stg_weather": lambda: sinks.write_table(
            wx_df, wx_path, "overwrite", partition_by=["weather_hour"], cluster_by=["canonical_city"]),
    }, workers))
    stg = _read_back(spark, stg_path, stg_df)
    wx_dated = spark.read.schema(wx_df.schema).parquet(wx_path)  # with its partition column, for pruning
    wx = wx_dated.select(wx_df.columns)
    cat = enrich.with_category(stg, breakpoints)

    joined_path = f"{warehouse}/int/aqi_weather_joined"
    joined_df = enrich.join_weather(cat, wx)
    out.loaded["aqi_weather_joined"] = sinks.write_table(
        joined_df, joined_path, "overwrite", partition_by=["reading_date"], cluster_by=["canonical_city"])
    joined = _read_back(spark, joined_path, joined_df)

    trends_path = f"{warehouse}/marts/city_aqi_trends"
    layouts = {
        "city_aqi_trends": (lambda: marts.city_trends(joined), ["reading_date"]),
        "pollutant_breakdown": (lambda: marts.pollutant_breakdown(cat), ["reading_date"]),
        "weather_aqi_correlation": (lambda: marts.weather_correlation(joined), []),
        "rain_impact": (lambda: marts.rain_impact(joined), ["rain_event_date"]),
        "features_city_air_quality": (lambda: marts.city_features(joined), ["reading_hour"]),
    }

    def mart(name: str, build: Callable[[], DataFrame], parts: list[str]) -> Callable[[], int]:
        return lambda: sinks.write_table(build(), f"{warehouse}/marts/{name}", "overwrite",
                                         partition_by=parts, cluster_by=["canonical_city"])

    out.loaded.update(_concurrently(
        {name: mart(name, build, parts) for name, (build, parts) in layouts.items()}, workers))
    out.loaded["worst_best_cities"] = sinks.write_table(
        marts.city_leaderboard(_read_back(spark, trends_path, marts.city_trends(joined))),
        f"{warehouse}/marts/worst_best_cities", "overwrite", cluster_by=["canonical_city"])

    as_of = as_of or _now()
    load_id = load_id or load_name(as_of)
    report = quality.all_checks(stg, wx, cat, joined, as_of).persist()
    try:
        failures = report.agg(F.coalesce(F.sum("failures"), F.lit(0))).first()[0]
        metrics = quality.quality_metrics(stg, wx_dated, read_raw(spark, warehouse, "invalid_records"),
                                          as_of, test_failures=int(failures))
        _concurrently({
            "metrics": lambda: sinks.write_load(metrics, f"{warehouse}/quality/metrics", load_id),
            "health": lambda: sinks.write_load(quality.pipeline_health(stg, wx_dated, as_of),
                                               f"{warehouse}/quality/health", load_id),
        }, workers)
        written = _read_back(spark, f"{warehouse}/quality/metrics", metrics)
        report = report.unionByName(quality.metrics_fresh_check(written, as_of))
        run_at = F.lit(as_of).cast("timestamp")
        sinks.write_load(report.withColumn("run_timestamp", run_at), f"{warehouse}/quality/tests", load_id)
        out.failed_tests = report.where(F.col("status") == "fail").count()
    finally:
        report.unpersist()
    return out


def run(spark: SparkSession, aqi_landing: str, weather_landing: str, warehouse: str,
        run_ts: str | None = None, as_of: str | None = None,
        city_map: DataFrame | None = None, breakpoints: DataFrame | None = None,
        multiline: bool = True, workers: int = 4) -> RunResult:
    """The whole hourly run. ``workers`` independent jobs run side by side
    (1 = strictly one after the other)."""
    ensure_utc(spark)
    run_ts = run_ts or _now()
    as_of = as_of or run_ts
    stamp, load_id = _stamp(run_ts), load_name(run_ts)
    city_map = city_map if city_map is not None else seeds.default_city_map(spark)
    breakpoints = breakpoints if breakpoints is not None else seeds.default_breakpoints(spark)
    loads = _concurrently({
        "aqi": lambda: ingest_readings(spark, aqi_landing, warehouse, stamp, load_id, multiline),
        "weather": lambda: ingest_weather(spark, weather_landing, warehouse, stamp, load_id, multiline),
    }, workers)
    (a_good, a_bad), (w_good, w_bad) = loads["aqi"], loads["weather"]
    result = build_models(spark, warehouse, city_map, breakpoints, as_of, workers, load_id)
    result.loaded.update({"aqi_readings": a_good, "weather_readings": w_good,
                          "invalid_records": a_bad + w_bad})
    return result
