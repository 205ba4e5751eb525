"""Loads of the raw tables: clean input, repeated runs, backfills beside runs."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from haze import cli
from haze.functions.exprs import epoch_to_timestamp
from haze.functions.joins import range_lookup
from haze.operators import backfill
from haze.plans import pipeline
from haze.session import scratch_path

STAMP = "2024-01-02 00:00:00"


def _local(path):
    return path.removeprefix("file:")


def _write(path, name, docs):
    os.makedirs(_local(path), exist_ok=True)
    with open(f"{_local(path)}/{name}", "w") as fh:
        fh.writelines(json.dumps(d) + "\n" for d in docs)


def _reading(i, day=1, **other):
    return {"id": str(i), "city": "Delhi", "state": "DL", "station": f"S{i}", "pollutant_id": "PM10", "avg_value": str(40 + i),
            "min_value": "1", "max_value": "99", "last_update": f"{day:02d}/01/2024 12:00:00"} | other


WEATHER = {"name": "Delhi", "dt": 1704100000, "visibility": 9000, "main": {"temp": 20.5, "feels_like": 20, "humidity": 40, "pressure": 1010},
           "wind": {"speed": 2.5, "deg": 90}, "weather": [{"main": "Clear"}]}


def _run(spark, root, stamp=STAMP):
    return pipeline.run(spark, f"{root}/aqi", f"{root}/weather", f"{root}/wh", run_ts=stamp, as_of=stamp, multiline=False)


def _raw(spark, root, name):
    return pipeline.read_raw(spark, f"{root}/wh", name)


def test_clean_run_repeated_run_backfill_and_later_run(spark):
    root = scratch_path(spark, "loads")
    _write(f"{root}/aqi", "p1.json", [{"records": [_reading(1), _reading(2)]}])
    _write(f"{root}/weather", "w1.json", [WEATHER])
    for _ in range(2):  # no bad record; the second run is a retry
        result = _run(spark, root)
        assert result.loaded["aqi_readings"] == 2 and result.loaded["invalid_records"] == 0
        assert _raw(spark, root, "aqi_readings").count() == 2 and _raw(spark, root, "weather_readings").count() == 1
        assert _raw(spark, root, "invalid_records").count() == 0
    assert spark.read.parquet(f"{root}/wh/quality/tests").count() == 13
    assert cli.main(["freshness", "--warehouse", f"{root}/wh", "--as-of", STAMP], spark=spark) == 0
    # a backfill into the raw table of the runs, then a run over one new page
    _write(f"{root}/old", "b.json", [{"records": [_reading(7, 1), _reading(8, 1, avg_value="bad")]}])
    args = ["backfill-readings", "--landing", f"{root}/old", "--start", "2024-01-01", "--end", "2024-01-03",
            "--ledger", f"{root}/wh/ledger", "--out", f"{root}/wh/raw/aqi_readings", "--json-lines"]
    for _ in range(2):
        assert cli.main(args, spark=spark) == 0
        assert _raw(spark, root, "aqi_readings").count() == 3 and _raw(spark, root, "invalid_records").count() == 1
    _write(f"{root}/aqi", "p2.json", [{"records": [_reading(3), _reading(4, city=" ")]}])
    result = _run(spark, root, "2024-01-02 01:00:00")
    assert result.loaded["aqi_readings"] == 1  # only the new page
    assert sorted(r.station_id for r in _raw(spark, root, "aqi_readings").collect()) == ["1", "2", "3", "7"]
    assert _raw(spark, root, "invalid_records").count() == 2


def test_backfill_reads_other_names_and_leaves_failed_days_open(spark):
    root = scratch_path(spark, "backfill")
    other = _reading(1, 1) | {"pollutant_avg": "41", "pollutant_min": "1", "pollutant_max": "9"}
    for name in ("avg_value", "min_value", "max_value"):
        del other[name]
    _write(f"{root}/old", "b.json", [{"records": [other, _reading(2, 2, avg_value="x"), _reading(3, 9, avg_value="x")]}])
    run = lambda: backfill.backfill_readings(
        spark, f"{root}/old", "2024-01-01", "2024-01-03", f"{root}/ledger", f"{root}/raw/aqi_readings",
        F.lit(STAMP).cast("timestamp"), multiline=False)
    for n in (1, 0):
        assert run() == n
        rows = spark.read.parquet(f"{root}/raw/aqi_readings").collect()
        assert [(r.station_id, r.pollutant_avg) for r in rows] == [("1", 41.0)]
        bad = spark.read.parquet(f"{root}/raw/invalid_records").collect()
        assert len(bad) == 1 and '"id":"2"' in bad[0].raw_payload.replace(" ", "")
        assert [r.day for r in spark.read.parquet(f"{root}/ledger").collect()] == [dt.date(2024, 1, 1)]
    _write(f"{root}/old", "c.json", [{"records": [_reading(4, 2)]}])  # the page of day 2 comes again, repaired
    assert run() == 1


def test_weather_backfill_keeps_other_cities(spark):
    root = scratch_path(spark, "archive")
    hourly = {"time": ["2024-01-01T00:00"], "temperature_2m": [20.0], "relativehumidity_2m": [50.0], "windspeed_10m": [3.0], "precipitation": [0.0]}
    _write(f"{root}/archive", "a.json", [{"city": c, "hourly": hourly} for c in ("Pune", "Delhi", "A/b=c")])
    for city in ("Pune", "Delhi", "Pune", "A/b=c"):
        cities = spark.createDataFrame([(city,)], "city string")
        assert backfill.backfill_weather(spark, f"{root}/archive", "2024-01-01", "2024-01-01", f"{root}/raw",
                                         F.lit(STAMP).cast("timestamp"), cities, multiline=False) == 1
    assert sorted(r.city for r in spark.read.parquet(f"{root}/raw").collect()) == ["A/b=c", "Delhi", "Pune"]


def test_range_lookup_finds_its_own_bucket_width(spark):
    ranges = spark.createDataFrame([(i * 10.0, i * 10.0 + 9, f"r{i}") for i in range(50)] + [(200.0, 900.0, "wide")], "lo double, hi double, label string")
    values = spark.range(-20, 1000, 7).select(F.col("id").cast("double").alias("v"))
    got = sorted(map(tuple, range_lookup(values, values["v"], ranges, "lo", "hi", max_rows=0).select("v", "label").collect()), key=str)
    want = sorted(map(tuple, range_lookup(values, values["v"], ranges, "lo", "hi", small=True).select("v", "label").collect()), key=str)
    assert got == want and len(got) > 146


def test_epochs_beyond_any_instant_are_null(spark):
    rows = spark.createDataFrame([(2**63 - 1,), (-2**63,), (0,)], "x long").select(epoch_to_timestamp("x").cast("string").alias("t")).collect()
    assert [r.t for r in rows][:2] == [None, None] and rows[2].t is not None
