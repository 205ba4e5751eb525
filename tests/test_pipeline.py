"""End-to-end run over payloads landed from the driver's sf0.001 events."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from haze.plans import pipeline
from haze.plans.catalog import finalize
from haze.session import scratch_path
from haze.sources import fixtures


def test_hourly_run_builds_every_table(spark):
    root = scratch_path(spark, "pipeline-test")
    events = fixtures.read_table(spark, SF_SMALL, "events")
    fixtures.land_aqi_pages(events, f"{root}/landing/aqi", files=2)
    fixtures.land_weather_objects(events, f"{root}/landing/weather", files=2)
    res = pipeline.run(spark, f"{root}/landing/aqi", f"{root}/landing/weather", f"{root}/wh",
                       run_ts="2024-01-31 00:00:00", as_of="2024-01-30 23:30:00",
                       city_map=fixtures.city_map(fixtures.read_table(spark, SF_SMALL, "nation")),
                       multiline=False)
    n = events.count()
    assert res.loaded["aqi_readings"] + res.loaded["invalid_records"] >= n  # weather bad rows too
    assert res.loaded["aqi_readings"] > 0 and res.loaded["weather_readings"] > 0
    for name in ("aqi_weather_joined", "city_aqi_trends", "pollutant_breakdown", "rain_impact",
                 "weather_aqi_correlation", "features_city_air_quality", "worst_best_cities"):
        assert res.loaded[name] > 0, name
    # the landed payloads include readings dated 6 March 2024, after as_of + 6 h:
    # exactly the future-timestamp test fails
    assert res.failed_tests == 1
    tests = spark.read.parquet(f"{root}/wh/quality/tests")
    failing = [r.test_name for r in tests.where(F.col("status") != "pass").collect()]
    assert tests.count() == 13 and failing == ["no_future_timestamps"]
    metrics = spark.read.parquet(f"{root}/wh/quality/metrics").first()
    assert metrics.test_failures == tests.agg(F.sum("failures")).first()[0] > 0
    trends = spark.read.parquet(f"{root}/wh/marts/city_aqi_trends")
    assert trends.count() == res.loaded["city_aqi_trends"]


def test_cli_freshness_and_test_on_a_built_warehouse(spark, capsys):
    from haze import cli
    root = scratch_path(spark, "cli-wh")
    events = fixtures.read_table(spark, SF_SMALL, "events")
    fixtures.land_aqi_pages(events, f"{root}/landing/aqi")
    fixtures.land_weather_objects(events, f"{root}/landing/weather")
    assert cli.main(["run", "--aqi-landing", f"{root}/landing/aqi", "--weather-landing",
                     f"{root}/landing/weather", "--warehouse", f"{root}/wh", "--json-lines",
                     "--as-of", "2024-03-31 00:00:00", "--run-ts", "2024-01-31 00:00:00"], spark=spark) == 0
    capsys.readouterr()
    assert cli.main(["test", "--warehouse", f"{root}/wh", "--as-of", "2024-03-31 00:00:00"], spark=spark) == 0
    assert cli.main(["freshness", "--warehouse", f"{root}/wh", "--as-of", "2024-01-31 01:00:00"],
                    spark=spark) == 0
    out = capsys.readouterr().out
    assert "aqi_readings" in out and "not checked" in out
    assert cli.main(["freshness", "--warehouse", f"{root}/wh", "--as-of", "2024-02-01 00:00:00"],
                    spark=spark) == 1  # a day old: error


def test_run_with_no_valid_readings(spark):
    import json
    import os
    root = scratch_path(spark, "empty-run")
    local = root.removeprefix("file:")  # a local folder in tests
    os.makedirs(f"{local}/aqi", exist_ok=True)
    os.makedirs(f"{local}/weather", exist_ok=True)
    with open(f"{local}/aqi/p.json", "w") as fh:
        json.dump({"records": [{"city": "Delhi"}]}, fh)          # fails validation
    with open(f"{local}/weather/w.json", "w") as fh:
        json.dump({"name": "Pune"}, fh)                           # fails validation
    res = pipeline.run(spark, f"{root}/aqi", f"{root}/weather", f"{root}/wh",
                       run_ts="2024-01-31 00:00:00", as_of="2024-01-31 00:00:00")
    assert res.loaded["aqi_readings"] == 0 and res.loaded["invalid_records"] == 2
    assert res.loaded["city_aqi_trends"] == 0 and res.failed_tests == 0
    m = spark.read.parquet(f"{root}/wh/quality/metrics").first()
    assert m.aqi_rows_last_hour == 0 and m.freshness_minutes == 0 and m.quarantine_rows_last_hour == 2


def test_run_results_do_not_depend_on_concurrency(spark):
    root = scratch_path(spark, "conc")
    events = fixtures.read_table(spark, SF_SMALL, "events")
    fixtures.land_aqi_pages(events, f"{root}/aqi", files=2)
    fixtures.land_weather_objects(events, f"{root}/weather", files=2)
    cm = fixtures.city_map(fixtures.read_table(spark, SF_SMALL, "nation"))
    tables = {}
    for workers in (1, 4):
        wh = f"{root}/wh{workers}"
        pipeline.run(spark, f"{root}/aqi", f"{root}/weather", wh, run_ts="2024-01-31 00:00:00",
                     as_of="2024-01-30 23:30:00", city_map=cm, multiline=False, workers=workers)
        tables[workers] = {name: sorted(map(repr, finalize(spark.read.parquet(f"{wh}/marts/{name}")).collect()))
                           for name in ("city_aqi_trends", "rain_impact", "worst_best_cities")}
    assert tables[1] == tables[4]
