"""Command-line entry points (``spark-submit -m``-style: ``python -m haze.cli ...``).

    run               one hourly run: ingest landed payloads, build models, marts, checks
    backfill-readings replay landed AQI pages for the pending days of a date range
    backfill-weather  explode landed archive payloads for a date range (and cities)
    freshness         warn / error by the age of the newest load of each raw table
    test              the checks report on a built warehouse (exit 1 on a failure)
    stream-ingest     incremental ingest of newly landed AQI pages (available-now)

The session comes from ``SparkSession.builder.getOrCreate()``, i.e. from the
submitter's configuration; only the UTC session time zone is enforced.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from haze.session import ensure_utc


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="haze")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("run", help="one pipeline run")
    r.add_argument("--aqi-landing", required=True)
    r.add_argument("--weather-landing", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--run-ts", help="run stamp (default: now)")
    r.add_argument("--as-of", help="instant for recency metrics (default: now)")
    r.add_argument("--city-map", help="CSV raw_city_name,canonical_city (default: packaged)")
    r.add_argument("--breakpoints", help="CSV min_aqi,max_aqi,category,health_message")
    r.add_argument("--json-lines", action="store_true", help="landed files are JSON Lines")
    r.add_argument("--workers", type=int, default=4, help="independent jobs run side by side")

    b = sub.add_parser("backfill-readings", help="replay landed AQI pages by day")
    b.add_argument("--landing", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--ledger", required=True, help="table of completed days")
    b.add_argument("--out", required=True, help="raw readings table")
    b.add_argument("--quarantine", help="default: invalid_records beside the raw table")
    b.add_argument("--run-ts")
    b.add_argument("--json-lines", action="store_true")

    w = sub.add_parser("backfill-weather", help="explode landed hourly archive payloads")
    w.add_argument("--archive", required=True)
    w.add_argument("--start", required=True)
    w.add_argument("--end", required=True)
    w.add_argument("--out", required=True, help="raw weather table; the range's dates of the given cities are replaced")
    w.add_argument("--cities", help="JSON array of {city, lat, lon} (default: packaged list)")
    w.add_argument("--all-cities", action="store_true", help="keep every city of the archive")
    w.add_argument("--wind-unit", default="as_is", choices=["as_is", "ms", "kmh"])
    w.add_argument("--run-ts")
    w.add_argument("--json-lines", action="store_true")

    f = sub.add_parser("freshness", help="source freshness of the raw tables")
    f.add_argument("--warehouse", required=True)
    f.add_argument("--as-of", help="instant to measure against (default: now)")

    t = sub.add_parser("test", help="run the checks on a built warehouse")
    t.add_argument("--warehouse", required=True)
    t.add_argument("--as-of")

    s = sub.add_parser("stream-ingest", help="ingest newly landed AQI pages")
    s.add_argument("--landing", required=True)
    s.add_argument("--readings", required=True)
    s.add_argument("--quarantine", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--source", default="aqi", choices=["aqi", "weather"])
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--json-lines", action="store_true")
    return p


def _stamp(run_ts: str | None):
    """One run stamp for the whole command (fixed on the driver)."""
    from haze.plans.pipeline import _stamp as stamp
    return stamp(run_ts)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = ensure_utc(spark or SparkSession.builder.getOrCreate())
    multiline = not getattr(args, "json_lines", False)
    if args.cmd == "run":
        from haze.plans import pipeline
        from haze.sources import seeds
        res = pipeline.run(
            spark, args.aqi_landing, args.weather_landing, args.warehouse,
            run_ts=args.run_ts, as_of=args.as_of,
            city_map=seeds.read_city_map(spark, args.city_map) if args.city_map else None,
            breakpoints=seeds.read_breakpoints(spark, args.breakpoints) if args.breakpoints else None,
            multiline=multiline, workers=args.workers)
        print(f"loaded={res.loaded} failed_tests={res.failed_tests}")
        return 1 if res.failed_tests else 0
    if args.cmd == "backfill-readings":
        from haze.operators import backfill
        n = backfill.backfill_readings(spark, args.landing, args.start, args.end, args.ledger,
                                       args.out, _stamp(args.run_ts), args.quarantine, multiline)
        print(f"rows={n}")
        return 0
    if args.cmd == "backfill-weather":
        from haze.operators import backfill
        from haze.sources import seeds
        cities = (None if args.all_cities else
                  seeds.read_cities(spark, args.cities) if args.cities else seeds.default_cities(spark))
        n = backfill.backfill_weather(spark, args.archive, args.start, args.end, args.out,
                                      _stamp(args.run_ts), cities, args.wind_unit, multiline)
        print(f"rows={n}")
        return 0
    if args.cmd in ("freshness", "test"):
        from haze import sinks
        from haze.operators import quality
        from haze.plans import pipeline
        wh = args.warehouse
        if args.cmd == "freshness":
            report = quality.source_freshness({
                "aqi_readings": (pipeline.read_raw(spark, wh, "aqi_readings"), "fetched_at"),
                "weather_readings": (pipeline.read_raw(spark, wh, "weather_readings"), "fetched_at"),
                "invalid_records": (pipeline.read_raw(spark, wh, "invalid_records"), "quarantined_at",
                                    None, None),
            }, args.as_of)
            bad = "error"
        else:
            stg = spark.read.parquet(f"{wh}/stg/readings")
            wx = spark.read.parquet(f"{wh}/stg/weather")
            joined = spark.read.parquet(f"{wh}/int/aqi_weather_joined")  # with the categories that the run gave
            metrics = sinks.read_table(spark, f"{wh}/quality/metrics", "run_timestamp timestamp")
            report = quality.all_checks(stg, wx, joined, joined, args.as_of).unionByName(
                quality.metrics_fresh_check(metrics, args.as_of))
            bad = "fail"
        rows = report.collect()  # one row per source or test
        for r in rows:
            print(" ".join(str(v) for v in r))
        return 1 if any(r.status == bad for r in rows) else 0
    from haze.streaming import ingest
    q = ingest.start_ingest(spark, args.landing, args.readings, args.quarantine, args.checkpoint,
                            multiline, args.max_files_per_trigger, source=args.source)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
