"""Route-once ingestion, the file ledger and the hourly run over a warehouse."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from haze.functions.joins import maybe_broadcast
from haze.operators import quality, validate
from haze.plans import hourly, incremental
from haze.session import scratch_path
from haze.snapshots import Warehouse
from haze.sources import fixtures, landing

from conftest import SF_SMALL



def _stamp():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def events(spark):
    return fixtures.read_table(spark, SF_SMALL, "events")


@pytest.mark.parametrize("archived", [False, True])
def test_routed_readings_equal_two_filters(spark, events, archived):
    path = scratch_path(spark, "test-landing")
    fixtures.land_aqi_pages(events, path, archived=archived)
    records = landing.aqi_records(landing.read_aqi_pages(spark, path, multiline=False))
    routed = validate.route_readings(records, _stamp(), fallback_first=archived)
    checked = validate.validate_readings(records, fallback_first=archived)
    good = validate.normalize_readings(checked.where("error_field IS NULL"), _stamp())
    bad = validate.quarantine_rows(checked, "aqi", _stamp())
    assert good.count() and bad.count()
    assert _rows(routed.where("outcome = 'good'").select(good.columns)) == _rows(good)
    assert _rows(routed.where("outcome = 'bad'").select(bad.columns)) == _rows(bad)


def test_routed_weather_equals_two_filters(spark, events):
    path = scratch_path(spark, "test-landing")
    fixtures.land_weather_objects(events, path)
    objects = landing.read_weather_objects(spark, path, multiline=False)
    routed, checked = validate.route_weather(objects, _stamp()), validate.validate_weather(objects)
    good = validate.normalize_weather(checked.where("error_field IS NULL"), _stamp())
    bad = validate.quarantine_rows(checked, "weather", _stamp(), payload=validate.weather_quarantine_payload())
    assert _rows(routed.where("outcome = 'good'").select(good.columns)) == _rows(good)
    assert _rows(routed.where("outcome = 'bad'").select(bad.columns)) == _rows(bad)


def test_each_record_is_parsed_once(spark, events):
    path = scratch_path(spark, "test-landing")
    fixtures.land_aqi_pages(events, path)
    routed = validate.route_readings(landing.aqi_records(landing.read_aqi_pages(spark, path, multiline=False)), _stamp())
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert all(plan.count(f"AS {c}#") == 1 for c in ("_avg", "_min", "_max", "_at"))  # in one projection, not inlined


def test_requested_city_of_nameless_payloads(spark):
    path = scratch_path(spark, "test-landing")
    for city, rows in (("Pune", ['{"dt": 1}', '{"name": "Poona", "dt": 2}']), ("Agra", ["not json"])):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(f"{path}/requested={city}")
    objects = landing.read_weather_objects(spark, path, multiline=False)
    manifest = fixtures.request_manifest(spark, path)
    routed = validate.route_weather(landing.with_request(objects, manifest), _stamp())
    assert sorted((json.loads(r.raw_payload)["city"], r.error_field) for r in routed.collect()) == [
        ("Agra", "unknown"), ("Pune", "main.temp"), ("Pune", "name")]
    none = validate.route_weather(landing.with_request(objects, manifest.limit(0)), _stamp())
    assert sorted(str(json.loads(r.raw_payload)["city"]) for r in none.collect()) == ["None", "None", "Poona"]


def test_a_large_city_is_landed_by_several_tasks(spark):
    events = spark.range(0, 40_000, 1, 8).selectExpr(
        "id AS event_id", "id % 2 * 3 AS user_id", "timestamp_seconds(1704067200 + id) AS ts", "'a' AS event_type", "id / 7 AS value")
    path = scratch_path(spark, "test-landing")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        fixtures.land_requested_weather(events, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = fixtures.request_manifest(spark, path).groupBy("city").count().collect()
    assert {r.city for r in files} == {"N0", "N3"} and all(r["count"] >= 4 for r in files)  # one task has a part of a city
    assert spark.read.text(path).count() == 40_000


def test_a_large_quarantine_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr("haze.snapshots.ROUTED_BYTES", "64KB")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(0, 40_000, 1, 8).select(F.lit("bad").alias("outcome"), F.sha2(F.col("id").cast("string"), 256).alias("raw_payload"))
    tx = Warehouse(spark, scratch_path(spark, "test-routed")).begin()
    count, dates, _ = tx.load_routed(rows, {"bad": ("invalid_records", ["raw_payload"], F.lit("2024-02-01"))}, "run-1")["bad"]
    table = tx.read("invalid_records")
    assert (count, dates, table.distinct().count()) == (40_000, {"2024-02-01"}, 40_000)
    assert table.select("_metadata.file_path").distinct().count() >= 8  # one date, still no task has it whole
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == size


def test_ledger_of_many_files(spark):
    """50,000 names: the anti join stays in Spark, only the mark comes to the driver."""
    wh = Warehouse(spark, scratch_path(spark, "test-warehouse"))
    path = scratch_path(spark, "test-landing")
    for _ in range(3):
        spark.range(1).select(F.lit("{}").alias("value")).write.mode("append").text(path)
    listed = landing.landed_files(spark, path)
    old = spark.range(50_000).select(F.lit("aqi").alias("source"), F.concat(F.lit("file:///gone/"), "id").alias("path"),
                                     F.lit(dt.datetime(2020, 1, 1)).alias("modified"), F.lit("run-0").alias("load"))
    one = listed.orderBy("path").limit(1).select(F.lit("aqi").alias("source"), "path", "modified", F.lit("run-1").alias("load"))
    tx = wh.begin()
    tx.load("loaded_files", old, F.lit("aqi"), "run-0-aqi")
    tx.load("loaded_files", one, F.lit("aqi"), "run-1-aqi")
    n = listed.count()
    assert n == 3
    assert hourly.fresh_files(tx, "aqi", path, "run-2", None).count() == n - 1  # another load has one
    assert hourly.fresh_files(tx, "aqi", path, "run-2", 24.0).count() == n - 1
    assert hourly.fresh_files(tx, "aqi", path, "run-1", 24.0).count() == n  # a repeated load gets its own again
    assert hourly.fresh_files(tx, "weather", path, "run-2", 24.0).count() == n


class _Killed(Exception):
    pass


def test_runs_take_each_file_once_and_publish_at_once(spark, events):
    root = scratch_path(spark, "test-hourly")
    wh = Warehouse(spark, f"{root}/wh")
    seeds = fixtures.city_map(fixtures.read_table(spark, SF_SMALL, "nation")), fixtures.breakpoints(spark)

    def land(k):
        fixtures.land_aqi_pages(events.where(F.col("event_id") % 2 == k), f"{root}/aqi/hour={k}", files=1)
        fixtures.land_weather_objects(events.where(F.col("event_id") % 2 == k), f"{root}/weather/hour={k}", files=1)

    def run(stamp, **settings):
        return hourly.run(wh, f"{root}/aqi", f"{root}/weather", stamp, *seeds, multiline=False, **settings)
    land(0)
    first = run("2024-01-30 20:00:00")
    total = events.where("event_id % 2 = 0").count()
    assert first.rows["aqi good"] + first.rows["aqi bad"] == first.rows["weather good"] + first.rows["weather bad"] == total
    assert wh.read("raw_readings").count() == first.rows["aqi good"]
    assert wh.read("invalid_records").count() == first.rows["aqi bad"] + first.rows["weather bad"]
    land(1)

    def hook(step):
        if step == "routed":
            raise _Killed
    with pytest.raises(_Killed):
        run("2024-01-30 21:00:00", hook=hook)
    assert wh.snapshot() == first.snapshot
    second = run("2024-01-30 21:00:00")
    again = run("2024-01-30 21:00:00")
    assert second.rows == again.rows and sum(n for k, n in second.rows.items() if k.startswith("aqi")) == events.count() - total
    assert wh.read("raw_readings").count() == first.rows["aqi good"] + second.rows["aqi good"]
    assert wh.read("quality_metrics").count() == 2 and wh.read("loaded_files").count() == wh.read("loaded_files").distinct().count()
    nothing = run("2024-01-30 22:00:00")
    assert set(nothing.rows.values()) == {0} and wh.read("raw_weather").count() == first.rows["weather good"] + second.rows["weather good"]
    stg, wx = wh.read("stg_readings"), wh.read("stg_weather")
    as_of = "2024-01-30 22:00:00"
    want = quality.quality_metrics(stg, wx, wh.read("invalid_records"), as_of, nothing.failed_tests).first()
    got = wh.read("quality_metrics").where(F.col("run_timestamp") == F.lit(as_of).cast("timestamp")).first()
    assert {k: v for k, v in got.asDict().items() if k != "test_failures"} == {k: v for k, v in want.asDict().items() if k != "test_failures"}
    assert wh.read("pipeline_health").where(F.col("run_timestamp") == F.lit(as_of).cast("timestamp")).first() == quality.pipeline_health(stg, wx, as_of).first()


def test_first_load_needs_both_sources(spark, events):
    wh = Warehouse(spark, scratch_path(spark, "test-hourly"))
    with pytest.raises(ValueError, match="raw_weather"):
        incremental.refresh(wh, "x", fixtures.aqi_readings(events), None, fixtures.city_map(fixtures.read_table(spark, SF_SMALL, "nation")),
                            maybe_broadcast(fixtures.breakpoints(spark)))
    assert wh.versions() == []
