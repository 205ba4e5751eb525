"""Validation, JSON landing, quarantine, backfill, streaming and sinks."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_MID
from haze import sinks
from haze.operators import backfill, validate
from haze.sources import fixtures, landing
from haze.streaming import ingest


def test_validation_counts_match_the_fixture_expectation(spark):  # V1-V5, V9
    events = fixtures.read_table(spark, SF_MID, "events")
    checked = validate.validate_readings(fixtures.aqi_payloads(events))
    got = {(r.error_field, r.error_reason): r.n for r in
           checked.groupBy("error_field", "error_reason").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {
        (None, None): 3350,
        ("avg_value", "not numeric"): 2820,
        ("avg_value", "out of range"): 1413,
        ("avg_value", "missing"): 730,
        ("last_update", "bad datetime format"): 606,
        ("city", "missing"): 527,
        ("max_value", "missing"): 282,
        ("city", "empty"): 155,
        ("station", "empty"): 117,
    }
    bad = validate.quarantine_rows(checked, "aqi", F.col("landed_at"))
    assert bad.count() + checked.where("error_field is null").count() == events.count()


def _write_pages(tmp, pages):
    os.makedirs(tmp, exist_ok=True)
    for i, page in enumerate(pages):
        with open(os.path.join(tmp, f"page_{i}.json"), "w") as fh:
            json.dump(page, fh, indent=2)


def test_landed_pages_fallback_fields_and_raw_payload(spark):  # S1, N1, E1, V12
    tmp = tempfile.mkdtemp(prefix="haze-land-")
    good = {"id": "1", "city": "Delhi", "state": "DL", "station": "ITO", "pollutant_id": "PM2.5",
            "avg_value": 55, "min_value": "10", "max_value": "90", "last_update": "01/01/2024 06:00:00"}
    only_fallback = {"id": "2", "city": "Delhi", "state": "DL", "station": "ITO", "pollutant_id": "NO2",
                     "pollutant_avg": "20", "pollutant_min": "1", "pollutant_max": "30",
                     "last_update": "01/01/2024 06:00:00"}
    nan_value = dict(good, id="3", avg_value="nan")
    _write_pages(tmp, [{"records": [good, only_fallback]}, {"records": [nan_value]}, {"records": []}])
    recs = landing.aqi_records(landing.read_aqi_pages(spark, tmp))
    checked = validate.validate_readings(recs).cache()
    errs = {r.id: (r.error_field, r.error_reason) for r in checked.collect()}
    assert errs == {"1": (None, None), "2": ("avg_value", "missing"), "3": (None, None)}
    # the fallback applies when the primary key is absent
    norm = {r.station_id: r for r in validate.normalize_readings(checked, F.current_timestamp()).collect()}
    assert norm["1"].pollutant_avg == 55.0 and norm["2"].pollutant_avg == 20.0
    assert norm["1"].reading_timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 30) or \
        norm["1"].reading_timestamp.astimezone(dt.timezone.utc).replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 30)
    bad = validate.quarantine_rows(checked, "aqi", F.current_timestamp()).collect()
    assert len(bad) == 1 and json.loads(bad[0].raw_payload) == only_fallback


def test_weather_object_validation_and_rain_default(spark):  # S2, V6-V8, N2, N3, N6
    tmp = tempfile.mkdtemp(prefix="haze-wx-")
    ok = {"name": "Pune", "dt": 1704067200, "main": {"temp": 25.5, "humidity": "40", "pressure": 1010},
          "wind": {"speed": 3.2, "deg": 90}, "weather": [{"main": "Clear"}], "visibility": 9000}
    hot = dict(ok, main={"temp": 61, "humidity": 40})
    no_cond = dict(ok, weather=[])
    rainy = dict(ok, rain={"1h": 1.5})
    _write_pages(tmp, [ok, hot, no_cond, rainy])
    objs = landing.read_weather_objects(spark, tmp)
    checked = validate.validate_weather(objs)
    from collections import Counter
    errs = Counter((r.error_field, r.error_reason) for r in checked.collect())
    assert errs == Counter([(None, None), ("main.temp", "out of range"),
                            ("weather[0].main", "missing"), (None, None)])
    norm = validate.normalize_weather(checked.where("error_field is null"), F.current_timestamp())
    assert sorted(r.rainfall_1h_mm for r in norm.collect()) == [0.0, 1.5]
    assert {r.humidity_pct for r in norm.collect()} == {40.0}


def test_backfill_replay_is_idempotent(spark):  # B1-B3
    root = tempfile.mkdtemp(prefix="haze-bf-")
    recs = [{"id": str(i), "city": "Delhi", "state": "DL", "station": f"S{i % 3}", "pollutant_id": "CO",
             "avg_value": str(10 + i), "min_value": "1", "max_value": "2",
             "last_update": f"{(i % 4) + 1:02d}/01/2024 12:00:00"} for i in range(20)]
    _write_pages(f"{root}/landing", [{"records": recs}])
    ts = F.lit("2024-02-01 00:00:00").cast("timestamp")
    n1 = backfill.backfill_readings(spark, f"{root}/landing", "2024-01-01", "2024-01-03",
                                    f"{root}/ledger", f"{root}/out", ts)
    first = sorted(spark.read.parquet(f"{root}/out").select("station_id").collect())
    n2 = backfill.backfill_readings(spark, f"{root}/landing", "2024-01-01", "2024-01-03",
                                    f"{root}/ledger", f"{root}/out", ts)
    assert n1 == 15 and n2 == 0  # day 4 outside the range; second run finds nothing pending
    assert sorted(spark.read.parquet(f"{root}/out").select("station_id").collect()) == first
    # forget the ledger: the replay rewrites the same partitions, no duplicates
    n3 = backfill.backfill_readings(spark, f"{root}/landing", "2024-01-01", "2024-01-03",
                                    f"{root}/ledger2", f"{root}/out", ts)
    assert n3 == 15
    assert sorted(spark.read.parquet(f"{root}/out").select("station_id").collect()) == first
    spine = backfill.day_spine(spark, "2024-01-30", "2024-02-02").collect()
    assert [r.day for r in spine] == [dt.date(2024, 1, 30), dt.date(2024, 1, 31),
                                      dt.date(2024, 2, 1), dt.date(2024, 2, 2)]


def test_archive_explode_pads_short_arrays(spark):  # S4, N8, U1
    tmp = tempfile.mkdtemp(prefix="haze-arch-")
    _write_pages(tmp, [{"city": "Pune", "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"],
        "temperature_2m": [20.0, 21.0], "relativehumidity_2m": [50.0, 51.0, 52.0],
        "windspeed_10m": [36.0, 18.0, 7.2], "precipitation": [None]}}])
    rows = landing.hourly_rows(landing.read_archive(spark, tmp), F.current_timestamp(), wind_unit="kmh")
    got = sorted(rows.collect(), key=lambda r: r.recorded_at)
    assert [r.temp_celsius for r in got] == [20.0, 21.0, None]
    assert [r.rainfall_1h_mm for r in got] == [None, 0.0, 0.0]
    assert [round(r.wind_speed_mps, 6) for r in got] == [10.0, 5.0, 2.0]


def test_streaming_ingest_second_run_adds_nothing(spark):  # T1
    root = tempfile.mkdtemp(prefix="haze-stream-")
    recs = [{"id": str(i), "city": "Delhi" if i % 5 else "  ", "state": "DL", "station": "S",
             "pollutant_id": "CO", "avg_value": str(i), "min_value": "1", "max_value": "2",
             "last_update": "01/01/2024 12:00:00"} for i in range(30)]
    _write_pages(f"{root}/landing", [{"records": recs[:15]}, {"records": recs[15:]}])
    for _ in range(2):
        q = ingest.start_ingest(spark, f"{root}/landing", f"{root}/good", f"{root}/bad",
                                f"{root}/ckpt", max_files_per_trigger=1)
        q.awaitTermination()
    good = spark.read.parquet(f"{root}/good")
    bad = spark.read.parquet(f"{root}/bad")
    assert good.count() == 24 and bad.count() == 6
    assert good.select("load_id").distinct().count() == 2


def test_write_table_counts_and_clusters(spark):  # K1 K5 K6 K7
    root = tempfile.mkdtemp(prefix="haze-sink-")
    df = spark.createDataFrame(
        [(f"C{i % 4}", dt.datetime(2024, 1, 1 + i % 3, i % 24), float(i)) for i in range(50)],
        "canonical_city string, reading_hour timestamp, v double")
    n = sinks.write_table(df, f"{root}/t", "overwrite", partition_by=["reading_hour"],
                          cluster_by=["canonical_city"])
    back = spark.read.parquet(f"{root}/t")
    assert n == 50 and back.count() == 50
    assert "reading_hour_date" in back.columns
    assert sinks.write_quarantine(spark.createDataFrame([], "source string, x int"), f"{root}/q") == 0
    assert not os.path.exists(f"{root}/q")


def test_unreadable_pages_and_records_are_quarantined_as_unknown(spark):  # V9
    tmp = tempfile.mkdtemp(prefix="haze-bad-")
    with open(os.path.join(tmp, "p.json"), "w") as fh:
        fh.write('{"records": [{"city": "Delhi"}, 7, "x"]}\n{"records": [{"city": \n{"records": []}\n')
    recs = landing.aqi_records(landing.read_aqi_pages(spark, tmp, multiline=False))
    checked = validate.validate_readings(recs)
    got = sorted((r.raw_payload, r.error_field, r.error_reason) for r in checked.collect())
    assert got == [('7', 'unknown', 'record is not a JSON object'),
                   ('x', 'unknown', 'record is not a JSON object'),
                   ('{"city": "Delhi"}', 'state', 'missing'),
                   ('{"records": [{"city": ', 'unknown', 'malformed page')]


def test_ensure_columns_and_source_freshness_rules(spark):  # N7, Q6
    from haze import schemas
    from haze.operators import quality
    df = spark.createDataFrame([("Pune", 1.5)], "city string, temp_celsius double")
    full = sinks.ensure_columns(df, schemas.WEATHER_READINGS)
    assert full.columns == [f.name for f in schemas.WEATHER_READINGS.fields]
    t = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9),)], "t timestamp")
    old = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1),)], "t timestamp")
    rep = {r.source_name: r.status for r in quality.source_freshness(
        {"fresh": (t, "t"), "stale": (old, "t"), "warned": (t, "t", 0, None),
         "unchecked": (old, "t", None, None)}, "2024-01-01 10:00:00").collect()}
    assert rep == {"fresh": "pass", "stale": "error", "warned": "warn", "unchecked": "not checked"}
    one = quality.check("no_negatives", df.where("temp_celsius < 0")).first()
    assert (one.failures, one.status) == (0, "pass")


def test_cli_backfill_weather(spark, capsys):  # B4 via the command line
    from haze import cli
    root = tempfile.mkdtemp(prefix="haze-cli-")
    _write_pages(f"{root}/archive", [{"city": c, "hourly": {
        "time": ["2024-01-01T23:00", "2024-01-02T00:00", "2024-01-03T00:00"],
        "temperature_2m": [1.0, 2.0, 3.0], "relativehumidity_2m": [1.0, 2.0, 3.0],
        "windspeed_10m": [1.0, 2.0, 3.0], "precipitation": [0.0, 0.1, 0.2]}} for c in ("Pune", "Delhi")])
    with open(f"{root}/cities.json", "w") as fh:
        json.dump([{"city": "Pune", "lat": 18.5, "lon": 73.8}], fh)
    rc = cli.main(["backfill-weather", "--archive", f"{root}/archive", "--start", "2024-01-02",
                   "--end", "2024-01-03", "--out", f"{root}/out", "--cities", f"{root}/cities.json"],
                  spark=spark)
    assert rc == 0 and "rows=2" in capsys.readouterr().out
    out = spark.read.parquet(f"{root}/out")
    assert {r.city for r in out.collect()} == {"Pune"} and out.count() == 2


def _readings(spark, rows):
    from haze import schemas
    data = [(None, "S1", "Pune", "MH", p, v, None, None, None, ts, ts) for p, v, ts in rows]
    return spark.createDataFrame(data, schemas.AQI_READINGS)


def test_stream_pivot_keeps_late_and_open_hours(spark):  # T2
    from haze.sources import seeds
    root = tempfile.mkdtemp(prefix="haze-t2-")
    t0 = dt.datetime(2024, 1, 1, 0, 10)
    run = lambda: ingest.start_hourly_pivot(
        spark, f"{root}/raw", seeds.default_city_map(spark), f"{root}/out", f"{root}/ckpt").awaitTermination()
    _readings(spark, [("CO", 1.0, t0), ("NO2", 2.0, t0 + dt.timedelta(minutes=5)),
                      ("CO", 3.0, t0 + dt.timedelta(hours=8))]).write.mode("append").parquet(f"{root}/raw")
    run()
    first = {r.reading_hour.hour: (r.co, r.no2) for r in spark.read.parquet(f"{root}/out").collect()}
    assert first == {0: (1.0, 2.0), 8: (3.0, None)}
    # a late reading for hour 00 and one 8 hours later
    _readings(spark, [("CO", 9.0, t0 + dt.timedelta(minutes=20)),
                      ("CO", 4.0, t0 + dt.timedelta(hours=16))]).write.mode("append").parquet(f"{root}/raw")
    run()
    out = {r.reading_hour.hour: (r.co, r.no2) for r in spark.read.parquet(f"{root}/out").collect()}
    assert out == {0: (9.0, 2.0), 8: (3.0, None), 16: (4.0, None)}


def test_stream_ingest_quarantines_a_malformed_page(spark):  # T1 + V9
    root = tempfile.mkdtemp(prefix="haze-t1bad-")
    os.makedirs(f"{root}/landing")
    with open(f"{root}/landing/bad.json", "w") as fh:
        fh.write('{"records": [{"city": "Delhi", "state"\n')
    ingest.start_ingest(spark, f"{root}/landing", f"{root}/good", f"{root}/bad", f"{root}/ckpt",
                        multiline=False).awaitTermination()
    bad = spark.read.parquet(f"{root}/bad").collect()
    assert [(r.error_field, r.error_reason) for r in bad] == [("unknown", "malformed page")]


def test_weather_dt_to_utc_instant(spark):  # N6
    from haze import schemas
    rows = [{"name": "Pune", "dt": dt_, "main": {"temp": 20, "humidity": 50},
             "wind": {"speed": 1}, "weather": [{"main": "Clear"}]}
            for dt_ in (1704067200, "1704067200", 1.7040672e9, "12.5x")]
    tmp = tempfile.mkdtemp(prefix="haze-dt-")
    _write_pages(tmp, rows)
    checked = validate.validate_weather(landing.read_weather_objects(spark, tmp))
    out = validate.normalize_weather(checked, F.current_timestamp(), keep=("error_field",)).select(
        "error_field", F.col("recorded_at").cast("timestamp_ntz").alias("t")).collect()
    good = [r.t for r in out if r.error_field is None]
    assert good == [dt.datetime(2024, 1, 1)] * 3
    assert [r.error_field for r in out if r.error_field] == ["unknown"]
    assert schemas.WEATHER_RECORD["dt"].dataType.simpleString() == "string"


def test_views_and_database_helpers(spark):  # K3, K4
    sinks.ensure_database(spark, "haze_test_db")
    assert any(d.name == "haze_test_db" for d in spark.catalog.listDatabases())
    sinks.register_views({"haze_numbers": spark.range(5)})
    assert spark.sql("SELECT count(*) AS n FROM haze_numbers").first().n == 5


def test_weather_type_mismatch_reports_the_path(spark):  # V8, V9
    tmp = tempfile.mkdtemp(prefix="haze-wxbad-")
    with open(os.path.join(tmp, "w.json"), "w") as fh:
        fh.write('{"name": "Pune", "dt": 1704067200, "main": "x", "wind": {"speed": 1}, "weather": [{"main": "C"}]}\n'
                 '{"name": "Pune", "dt": 1704067200, "main": {"temp": 20, "humidity": 50}, "wind": 5, '
                 '"weather": [{"main": "C"}]}\n{"name": "Pune", "dt": \n{}\n')
    checked = validate.validate_weather(landing.read_weather_objects(spark, tmp, multiline=False))
    got = sorted((r.error_field, r.error_reason) for r in checked.collect())
    assert got == [("main.temp", "missing"), ("name", "missing"), ("unknown", "malformed JSON"),
                   ("wind.speed", "missing")]


def test_fallback_first_validates_alternative_names(spark):  # E1 option
    tmp = tempfile.mkdtemp(prefix="haze-fb-")
    only_fallback = {"id": "2", "city": "Delhi", "state": "DL", "station": "ITO", "pollutant_id": "NO2",
                     "pollutant_avg": "20", "pollutant_min": "1", "pollutant_max": "30",
                     "last_update": "01/01/2024 06:00:00"}
    both = dict(only_fallback, id="3", avg_value="2000", pollutant_avg="20")
    _write_pages(tmp, [{"records": [only_fallback, both]}])
    recs = landing.aqi_records(landing.read_aqi_pages(spark, tmp))
    strict = {r.id: r.error_field for r in validate.validate_readings(recs).collect()}
    loose = {r.id: (r.error_field, r.error_reason) for r in
             validate.validate_readings(recs, fallback_first=True).collect()}
    assert strict == {"2": "avg_value", "3": "min_value"}
    assert loose == {"2": (None, None), "3": ("avg_value", "out of range")}  # primary name wins


def test_fallback_applies_to_absent_keys_not_null_values(spark):  # N1
    tmp = tempfile.mkdtemp(prefix="haze-nul-")
    base = {"city": "Delhi", "state": "DL", "station": "ITO", "pollutant_id": "NO2",
            "min_value": "1", "max_value": "3", "last_update": "01/01/2024 06:00:00"}
    _write_pages(tmp, [{"records": [dict(base, id="a", avg_value=None, pollutant_avg="7"),
                                    dict(base, id="b", pollutant_avg="8"),
                                    dict(base, id="c", avg_value="9", pollutant_avg="1")]}])
    recs = landing.aqi_records(landing.read_aqi_pages(spark, tmp))
    got = {r.station_id: r.pollutant_avg for r in validate.normalize_readings(recs, F.current_timestamp()).collect()}
    assert got == {"a": None, "b": 8.0, "c": 9.0}  # null avg_value is kept, absent falls back


def test_overwrite_partitions_replaces_only_present_days(spark):  # B3 building block
    root = tempfile.mkdtemp(prefix="haze-dyn-")
    first = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "v string, d date")
    assert sinks.overwrite_partitions(first, root, ["d"]) == 2
    again = spark.createDataFrame([("c", dt.date(2024, 1, 2)), ("d", dt.date(2024, 1, 2))], "v string, d date")
    assert sinks.overwrite_partitions(again, root, ["d"]) == 2
    got = sorted((r.v, r.d.day) for r in spark.read.parquet(root).collect())
    assert got == [("a", 1), ("c", 2), ("d", 2)]


def test_cli_backfill_readings_resumes(spark, capsys):  # B1-B3 via the command line
    from haze import cli
    root = tempfile.mkdtemp(prefix="haze-clibf-")
    recs = [{"id": str(i), "city": "Delhi", "state": "DL", "station": "S", "pollutant_id": "CO",
             "avg_value": str(i + 1), "min_value": "1", "max_value": "2",
             "last_update": f"0{1 + i % 3}/01/2024 12:00:00"} for i in range(9)]
    _write_pages(f"{root}/landing", [{"records": recs}])
    args = ["backfill-readings", "--landing", f"{root}/landing", "--start", "2024-01-01",
            "--end", "2024-01-02", "--ledger", f"{root}/ledger", "--out", f"{root}/out"]
    assert cli.main(args, spark=spark) == 0 and "rows=6" in capsys.readouterr().out
    assert cli.main(args[:6] + ["2024-01-03"] + args[7:], spark=spark) == 0  # only the new day
    assert "rows=3" in capsys.readouterr().out
    assert spark.read.parquet(f"{root}/out").count() == 9


def test_cli_stream_ingest(spark):  # T1 via the command line
    from haze import cli
    root = tempfile.mkdtemp(prefix="haze-clist-")
    recs = [{"id": str(i), "city": "Delhi" if i % 4 else None, "state": "DL", "station": "S",
             "pollutant_id": "CO", "avg_value": "5", "min_value": "1", "max_value": "2",
             "last_update": "01/01/2024 12:00:00"} for i in range(8)]
    _write_pages(f"{root}/landing", [{"records": recs}])
    args = ["stream-ingest", "--landing", f"{root}/landing", "--readings", f"{root}/good",
            "--quarantine", f"{root}/bad", "--checkpoint", f"{root}/ckpt"]
    assert cli.main(args, spark=spark) == 0
    assert spark.read.parquet(f"{root}/good").count() == 6
    assert spark.read.parquet(f"{root}/bad").count() == 2


def test_seed_csv_files_match_packaged_seeds(spark):  # S5, K8
    from haze.sources import seeds
    root = tempfile.mkdtemp(prefix="haze-seeds-")
    with open(f"{root}/city_map.csv", "w") as fh:
        fh.write("raw_city_name,canonical_city\n" + "".join(f"{a},{b}\n" for a, b in seeds.CITY_MAP_ROWS))
    with open(f"{root}/breakpoints.csv", "w") as fh:
        fh.write("min_aqi,max_aqi,category,health_message\n"
                 + "".join(f"{a},{b},{c},{d}\n" for a, b, c, d in seeds.BREAKPOINT_ROWS))
    assert sorted(seeds.read_city_map(spark, f"{root}/city_map.csv").collect()) == \
        sorted(seeds.default_city_map(spark).collect())
    assert sorted(seeds.read_breakpoints(spark, f"{root}/breakpoints.csv").collect()) == \
        sorted(seeds.default_breakpoints(spark).collect())
