"""The hourly run over a ``snapshots.Warehouse``: landed files -> raw rows -> models -> checks.

One transaction, published by one rename: files taken, raw rows, quarantine, models,
marts, statistics and reports belong to one version, and a run that dies anywhere
leaves the version before it.

* New files come from an anti join of the landing with the ledger table; their names
  stay in Spark. The landing is listed from a high-water mark on: the newest file
  that any load has taken, less ``overlap_hours`` (None lists all of it).
* Records are parsed once, and both outcomes are written in one pass.
* Metrics, health, freshness and the test report are answered from statistics that
  the writers keep for each hour and date; no run reads the history for them.

A repeated load takes its own files again and replaces what it wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haze import schemas, sinks
from haze.operators import quality, validate
from haze.plans import incremental
from haze.session import ensure_utc
from haze.snapshots import Snapshot, Transaction, Warehouse
from haze.sources import landing

LEDGER = "source string, path string, modified timestamp, load string"
ENVELOPE = schemas.INVALID_RECORDS.fieldNames()


@dataclass
class Outcome:
    snapshot: Snapshot
    rows: dict[str, int] = field(default_factory=dict)  # (source, outcome) as "aqi good"
    failed_tests: int = 0


def fresh_files(tx: Transaction, source: str, landing_path: str, load: str, overlap_hours: float | None) -> DataFrame:
    """(path, modified) of the files that no other load has taken; pinned, so that the rows
    and the ledger agree on them."""
    spark = tx.warehouse.spark
    taken = _ledger(tx).where((F.col("source") == source) & (F.col("load") != load))
    since = None
    if overlap_hours is not None:
        mark = taken.agg(F.max("modified")).first()[0]
        since = None if mark is None else F.lit(mark - dt.timedelta(hours=overlap_hours))
        taken = taken if since is None else taken.where(F.col("modified") >= since)
    files = landing.landed_files(spark, landing_path, since)
    return sinks.pinned(files.join(taken.select("path"), "path", "left_anti"), "fresh-files")


def _ledger(tx: Transaction) -> DataFrame:
    from pyspark.sql import types as T
    return tx.read("loaded_files", schema=T.StructType.fromDDL(LEDGER))


def _since(files: DataFrame) -> Column:
    """The oldest new file's time: older files are not opened (no file is as good as none)."""
    return F.lit(files.agg(F.min("modified")).first()[0] or dt.datetime(9000, 1, 1))


def ingest(tx: Transaction, changes: incremental.Changes, city_map: DataFrame, landings: dict[str, str], stamp: Column, load: str,
           multiline: bool = True, requests: DataFrame | None = None, overlap_hours: float | None = 24.0) -> dict[str, int]:
    """Loads the new files of both landings into the transaction; returns row counts."""
    spark, rows = tx.warehouse.spark, {}
    for source, path in landings.items():
        files = fresh_files(tx, source, path, load, overlap_hours)
        recent = F.col("_metadata.file_modification_time") >= _since(files)
        if source == "aqi":
            pages = landing.read_aqi_pages(spark, path, multiline).where(recent)
            routed = validate.route_readings(landing.of_files(landing.aqi_records(pages), files), stamp)
            table, schema, at = "raw_readings", schemas.AQI_READINGS, "reading_timestamp"
        else:
            objects = landing.of_files(landing.read_weather_objects(spark, path, multiline).where(recent), files)
            routed = validate.route_weather(objects if requests is None else landing.with_request(objects, requests), stamp)
            table, schema, at = "raw_weather", schemas.WEATHER_READINGS, "recorded_at"
        routes = {validate.GOOD: (table, schema.fieldNames(), F.to_date(at)),
                  validate.BAD: ("invalid_records", ENVELOPE, F.to_date("quarantined_at"))}
        done = tx.load_routed(routed, routes, f"{load}-{source}")
        rows |= {f"{source} {outcome}": n for outcome, (n, _, _) in done.items()}
        changes.add(table, *done[validate.GOOD][1:], city_map)
        bad = quality.invalid_stats(tx.warehouse._folders(_own(tx, "invalid_records", f"{load}-{source}"), schemas.INVALID_RECORDS))
        tx.load("invalid_stats", bad, F.to_date("quarantined_at"), f"{load}-{source}")
        named = files.select(F.lit(source).alias("source"), "path", "modified", F.lit(load).alias("load"))
        tx.load("loaded_files", named, F.lit(source), f"{load}-{source}")
    return rows


def _own(tx: Transaction, table: str, load: str) -> list[str]:
    """Folders that a load has in a table."""
    return [f for folders in tx.tables.get(table, {}).values() for f in folders if f.split("/")[1].startswith(f"load={load}~")]


def run(warehouse: Warehouse, aqi_landing: str, weather_landing: str, run_ts: str, city_map: DataFrame, breakpoints: DataFrame,
        as_of: str | None = None, multiline: bool = True, requests: DataFrame | None = None,
        overlap_hours: float | None = 24.0, workers: int = 4, hook: Callable[[str], None] | None = None) -> Outcome:
    """The whole hourly run; see the module. ``requests``: landing manifest (path, city)."""
    ensure_utc(warehouse.spark)
    as_of = as_of or run_ts
    load = "run-" + "".join(c for c in run_ts if c.isdigit())
    tx, changes = warehouse.begin(), incremental.Changes()
    tx.hook = hook or tx.hook
    rows = ingest(tx, changes, city_map, {"aqi": aqi_landing, "weather": weather_landing}, F.lit(run_ts).cast("timestamp"), load,
                  multiline, requests, overlap_hours)
    notes = incremental.rebuild(tx, changes, city_map, breakpoints, workers)
    readings, weather = tx.read("readings_stats"), tx.read("weather_stats")
    report = sinks.pinned(quality.report_from_stats(tx.read("daily_checks"), readings, as_of), "hourly-report")
    failures = int(report.agg(F.coalesce(F.sum("failures"), F.lit(0))).first()[0])
    at = F.to_date(F.lit(as_of).cast("timestamp"))
    metrics = quality.metrics_from_stats(readings, weather, tx.read("invalid_stats"), as_of, failures)
    tx.load("quality_metrics", metrics, at, load)
    tx.load("pipeline_health", quality.health_from_stats(readings, weather, as_of), at, load)
    report = report.unionByName(quality.metrics_fresh_check(tx.read("quality_metrics"), as_of))
    tx.load("test_report", report.withColumn("run_timestamp", F.lit(as_of).cast("timestamp")), at, load)
    failed = report.where(F.col("status") == "fail").count()
    return Outcome(tx.commit(notes), rows, failed)
