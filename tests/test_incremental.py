"""Incremental refreshes against a full refresh, reach by reach."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haze.operators import enrich, marts, moments, staging
from haze.plans import incremental as I
from haze.session import scratch_path
from haze.snapshots import Warehouse
from haze.sources import fixtures

READING = "station_id string, station_name string, city string, state string, pollutant_id string, pollutant_avg double, reading_timestamp timestamp, fetched_at timestamp"
WEATHER = ("city string, recorded_at timestamp, temp_celsius double, feels_like_celsius double, humidity_pct double, wind_speed_mps double, "
           "wind_direction_degrees double, weather_condition string, rainfall_1h_mm double, visibility_meters double, pressure_hpa double, fetched_at timestamp")
START = dt.datetime(2024, 3, 1)


def _at(day, hour):
    return START + dt.timedelta(days=day, hours=hour)


def _data(seed=3, days=16):
    """city a: hourly; b: one or two rows a day; c: one row every few days, rain on the first only."""
    rng, readings, weather = random.Random(seed), [], []
    for day in range(days):
        hours = {"a": range(0, 24, 2), "b": rng.sample(range(24), rng.randrange(1, 3)), "c": [5] if day % 3 == 0 else []}
        for city, hs in hours.items():
            for h in hs:
                t = _at(day, h)
                for pid in ("PM10", "PM2.5"):
                    readings.append((f"{city}{day}{h}{pid}", f"S{h % 2}", city, "R", pid, float(rng.randrange(1, 450)), t, t))
                rain = 2.0 if (city == "c" and day == 0) or (city != "c" and rng.random() < 0.2) else 0.0
                weather.append((city, t, 20.0 + rng.random(), None, float(rng.randrange(100)), rng.random() * 9, None, "x", rain, None, 1000.0, t))
    return readings, weather


def _full(spark, readings, weather, seeds):
    city_map, breakpoints = seeds
    stg = staging.stg_readings(spark.createDataFrame(readings, READING), city_map)
    wx = staging.stg_weather(spark.createDataFrame(weather, WEATHER), city_map)
    cat = enrich.with_category(stg, breakpoints)
    joined = enrich.join_weather(cat, wx)
    trends = marts.city_trends(joined)
    return {"city_aqi_trends": trends, "pollutant_breakdown": marts.pollutant_breakdown(cat), "rain_impact": marts.rain_impact(joined, block_rows=0),
            "weather_aqi_correlation": marts.weather_correlation(joined), "worst_best_cities": marts.city_leaderboard(trends),
            "features_city_air_quality": marts.city_features(joined, block_rows=0)}


def _rows(df):
    def plain(v):
        return "-" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())


def _same(spark, wh, readings, weather, seeds):
    for mart, df in _full(spark, readings, weather, seeds).items():
        assert _rows(wh.read(mart).select(df.columns)) == _rows(df), mart


@pytest.fixture
def seeds(spark):
    names = spark.createDataFrame([(c, c.upper()) for c in "ab"], "raw_city_name string, canonical_city string")
    return names, fixtures.breakpoints(spark)


def _load(spark, wh, load, readings, weather, seeds, **settings):
    r = spark.createDataFrame(readings, READING) if readings is not None else None
    w = spark.createDataFrame(weather, WEATHER) if weather is not None else None
    return I.refresh(wh, load, r, w, *seeds, **settings)


def test_late_rows_rain_and_repeated_loads(spark, seeds):
    readings, weather = _data()
    late_r = [r for r in readings if r[6] == _at(4, 4) or (r[2] == "b" and r[6].day == 6)]
    late_w = [w for w in weather if w[0] == "c" and w[1] == _at(0, 5)]  # the only rain of c: every later date depends on it
    wh = Warehouse(spark, scratch_path(spark, "test-incremental"))
    _load(spark, wh, "one", [r for r in readings if r not in late_r], [w for w in weather if w not in late_w], seeds)
    _load(spark, wh, "two", late_r, None, seeds)
    _same(spark, wh, readings, [w for w in weather if w not in late_w], seeds)
    before = wh.snapshot()
    after = _load(spark, wh, "three", None, late_w, seeds)
    _same(spark, wh, readings, weather, seeds)
    moved = {d for d, f in after.tables["features_city_air_quality"].items() if before.tables["features_city_air_quality"].get(d) != f}
    assert {"2024-03-01", "2024-03-04", "2024-03-16"} <= moved and "2024-03-02" not in moved  # c's dates, no others
    assert {d for d, f in after.tables["joined"].items() if before.tables["joined"].get(d) != f} == {"2024-03-01"}
    _load(spark, wh, "two", late_r[:1], None, seeds)  # the load again, with fewer rows
    _same(spark, wh, [r for r in readings if r not in late_r[1:]], weather, seeds)


def test_new_aliases_change_every_date(spark, seeds):
    readings, weather = _data(5, 6)
    wh = Warehouse(spark, scratch_path(spark, "test-incremental"))
    _load(spark, wh, "one", readings, weather, seeds)
    new = (spark.createDataFrame([("a", "Alpha"), ("b", "Alpha"), ("c", "Gamma")], "raw_city_name string, canonical_city string"), seeds[1])
    extra = [("late", "S0", "b", "R", "PM10", 77.0, _at(2, 23), _at(2, 23))]
    _load(spark, wh, "two", extra, None, new)
    _same(spark, wh, readings + extra, weather, new)


class _Killed(Exception):
    pass


def test_a_killed_run_leaves_one_version(spark, seeds):
    readings, weather = _data(7, 5)
    cut = [r for r in readings if r[6] < _at(3, 0)]
    wh = Warehouse(spark, scratch_path(spark, "test-incremental"))
    first = _load(spark, wh, "one", cut, weather, seeds)
    steps: list[str] = []
    _load(spark, Warehouse(spark, scratch_path(spark, "test-incremental")), "one", cut, weather, seeds, hook=steps.append)
    assert steps[-1] == "commit" and len(steps) == len(set(steps)) == 14
    rest = [r for r in readings if r not in cut]
    for step in steps[1::4] + ["commit"]:
        def hook(name, step=step):
            if name == step:
                raise _Killed(name)
        with pytest.raises(_Killed):
            _load(spark, wh, "two", rest, weather[:1], seeds, hook=hook)
        assert wh.snapshot() == first
    _same(spark, wh, cut, weather, seeds)
    _load(spark, wh, "two", rest, None, seeds)
    wh.vacuum(keep=1, min_age_hours=0)
    _same(spark, wh, readings, weather, seeds)


def test_reach_counts_rows_not_days(spark):
    """Against a scan over single rows."""
    rng = random.Random(9)
    for before, after in ((3, 23), (23, 3), (6, 3), (0, 1)):
        counts = [rng.choice([0, 1, 1, 2, 9, 30]) for _ in range(40)]
        flagged = {k for k in range(40) if rng.random() < 0.08}
        rows = [k for k, n in enumerate(counts) for _ in range(n)]
        want = set(flagged)
        for i, k in enumerate(rows):
            if k in flagged:
                want |= set(rows[max(0, i - before):i + after + 1])
        empty_ok = {k for k in range(40) if not counts[k]}
        days = spark.createDataFrame([("x", START.date() + dt.timedelta(days=k), n, k in flagged, k) for k, n in enumerate(counts)],
                                     "canonical_city string, reading_date date, rows long, flag boolean, k int")
        got = {r.k for r in I.within_reach(days, "flag", "rows", before, after, "near").where("near").collect()}
        flagged_rows = {k for k in flagged if counts[k]}
        assert want <= got, (before, after)
        if flagged == flagged_rows:
            assert got - want <= empty_ok


def test_correlations_from_states(spark):
    """Days merged in any cut, constant sides, missing values, far-off means."""
    rng = random.Random(2)
    rows = [(city, d, 1e7 + rng.random(), rng.choice([None, rng.random()]), 5.1, rng.random(), rng.random() if city == "one" else None)
            for city in ("x", "y", None) for d in range(9) for _ in range(rng.randrange(1, 12))] + [("one", 0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "canonical_city string, day int, composite_aqi double, wind_speed_mps double, humidity_pct double, temp_celsius double, rainfall_1h_mm double")
    plain = marts.weather_correlation(df.withColumn("has_weather_data", F.lit(True)))
    states = moments.daily_states(df, ["canonical_city", "day"])
    got = {r.canonical_city: r for r in moments.correlations(states, "canonical_city").collect()}
    for r in plain.collect():
        for name in r.asDict():
            a, b = r[name], got[r.canonical_city][name]
            assert a == b or abs(a - b) < 1e-6, (r.canonical_city, name, a, b)
        assert got[r.canonical_city].humidity_aqi_correlation is None
