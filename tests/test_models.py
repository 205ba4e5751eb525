"""Staging, enrichment and mart semantics on hand-made frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haze import schemas
from haze.operators import enrich, marts, quality, rows_window, staging
from haze.sources import seeds

H = dt.datetime(2024, 1, 1, 10)
US = int(H.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def raw_aqi(spark, rows):
    """rows: (station, city, state, pollutant_id, avg, reading epoch µs)."""
    data = [(None, st, c, s, p, a, None, None, None, ts, ts + 1) for st, c, s, p, a, ts in rows]
    schema = ("station_id string, station_name string, city string, state string, "
              "pollutant_id string, pollutant_avg double, pollutant_min double, "
              "pollutant_max double, pollutant_unit string, reading_timestamp long, fetched_at long")
    return spark.createDataFrame(data, schema)


def test_pivot_aliases_unknown_ids_and_filters(spark):  # A1, C2, P2, E2
    rows = [("S1", "Delhi", "DL", "pm2.5", 10.0, US), ("S1", "Delhi", "DL", "PM2_5", 12.0, US),
            ("S1", "Delhi", "DL", "o3", 7.0, US), ("S1", "Delhi", "DL", "PM_10", 3.0, US),
            ("S2", "Delhi", "DL", "XYZ", 5.0, US),
            ("S3", "Delhi", "DL", "NO2", None, US), ("S3", "Delhi", "DL", "NO2", -1.0, US),
            ("S3", "Delhi", "DL", "NO2", float("nan"), US), ("S3", "Delhi", "DL", "NO2", 0.0, US)]
    stg = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark))
    got = {r.station_name: r for r in stg.collect()}
    assert set(got) == {"S1", "S2"}  # S3 has no positive, non-NaN value
    assert got["S1"].pm25 == 12.0 and got["S1"].ozone == 7.0 and got["S1"].pm10 == 3.0
    assert all(got["S2"][c] is None for c in schemas.POLLUTANT_COLUMNS)
    cat = {r.station_name: r for r in enrich.with_category(stg, seeds.default_breakpoints(spark)).collect()}
    assert cat["S2"].composite_aqi == 0.0 and cat["S2"].aqi_category == "Good"


def test_city_alias_trimmed_and_unmapped_kept_as_is(spark):  # J1
    rows = [("S1", " Bombay ", "MH", "CO", 1.0, US), ("S2", " Nowhere ", "X", "CO", 1.0, US),
            ("S3", "bombay", "MH", "CO", 1.0, US)]
    stg = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark))
    got = {r.station_name: r.canonical_city for r in stg.collect()}
    assert got == {"S1": "Mumbai", "S2": " Nowhere ", "S3": "bombay"}


def test_two_stations_one_city_hour_stay_separate(spark):  # F1
    rows = [("S1", "Pune", "MH", "CO", 1.0, US), ("S2", "Pune", "MH", "CO", 2.0, US + 1_000_000)]
    stg = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark))
    assert stg.count() == 2
    assert {r.reading_hour.replace(tzinfo=None) for r in stg.select(
        F.col("reading_hour").cast("timestamp_ntz").alias("reading_hour")).collect()} == {H}


def test_reading_bucketed_to_utc_hour_and_date(spark):  # Z1
    ist_0600 = dt.datetime(2024, 1, 2, 0, 30, tzinfo=dt.timezone.utc)  # 06:00 IST
    rows = [("S1", "Pune", "MH", "CO", 1.0, int(ist_0600.timestamp()))]
    r = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark)).select(
        F.col("reading_hour").cast("timestamp_ntz").alias("h"), "reading_date").first()
    assert r.h == dt.datetime(2024, 1, 2, 0, 0) and r.reading_date == dt.date(2024, 1, 2)


def raw_weather(spark, rows):
    """rows: (city, recorded_at, fetched_at, temp, wind, rain)."""
    data = [(c, rec, t, None, 50.0, w, None, "Clear", r, None, None, f) for c, rec, f, t, w, r in rows]
    return spark.createDataFrame(data, schemas.WEATHER_READINGS)


def test_weather_dedup_latest_fetch_then_latest_record(spark):  # W1, D1, P6, P7
    f1, f2 = H + dt.timedelta(hours=1), H + dt.timedelta(hours=2)
    rows = [("Pune", H, f1, 20.0, 1.0, None),
            ("Pune", H + dt.timedelta(minutes=5), f2, 21.0, 3.0, None),
            ("Pune", H + dt.timedelta(minutes=9), f2, 22.0, None, 0.4)]  # same fetch: later record wins
    wx = staging.stg_weather(raw_weather(spark, rows), seeds.default_city_map(spark)).collect()
    assert len(wx) == 1
    assert wx[0].temp_celsius == 22.0 and wx[0].rainfall_1h_mm == 0.4 and wx[0].is_raining
    assert wx[0].wind_category == "Strong"  # NULL wind
    wx2 = staging.stg_weather(raw_weather(spark, rows[:2]), seeds.default_city_map(spark)).first()
    assert wx2.rainfall_1h_mm == 0.0 and wx2.is_raining is False


def test_breakpoint_gaps_and_overflow_are_uncategorized(spark):  # C1, J3
    stg = spark.createDataFrame(
        [("S", "C", "X", H, H.date(), v, None, None, None, None, None, None) for v in (50.0, 50.5, 51.0, 600.0)],
        "station_name string, canonical_city string, state string, reading_hour timestamp, "
        "reading_date date, pm25 double, pm10 double, no2 double, so2 double, co double, ozone double, nh3 double")
    out = {r.composite_aqi: r.aqi_category for r in
           enrich.with_category(stg, seeds.default_breakpoints(spark)).collect()}
    assert out == {50.0: "Good", 50.5: None, 51.0: "Satisfactory", 600.0: None}
    cov = quality.coverage_metrics(enrich.with_category(stg, seeds.default_breakpoints(spark))).first()
    assert cov.uncategorized_rows == 2


def test_bucketed_range_join_equals_broadcast(spark):
    from haze.functions.joins import range_lookup
    vals = spark.createDataFrame([(float(v) / 2,) for v in range(-4, 1100)], "v double")
    bp = seeds.default_breakpoints(spark)
    a = range_lookup(vals, vals["v"], bp, "min_aqi", "max_aqi").select("v", "category")
    b = range_lookup(vals, vals["v"], bp, "min_aqi", "max_aqi", max_rows=0, bucket_width=37.0) \
        .select("v", "category")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == vals.count()


def joined_frame(spark, rows):
    """rows: (city, station, hour offset, composite, rain, pm25, category)."""
    data = [(st, c, "X", H + dt.timedelta(hours=h), (H + dt.timedelta(hours=h)).date(), comp, cat,
             pm, None, None, None, None, None, None, 20.0, None, 50.0, 2.0, None, "Clear", rain,
             rain > 0, "Light", None, None, H, True) for c, st, h, comp, rain, pm, cat in rows]
    schema = ", ".join(f"{c} {t}" for c, t in [
        ("station_name", "string"), ("canonical_city", "string"), ("state", "string"),
        ("reading_hour", "timestamp"), ("reading_date", "date"), ("composite_aqi", "double"),
        ("aqi_category", "string"), ("pm25", "double"), ("pm10", "double"), ("no2", "double"),
        ("so2", "double"), ("co", "double"), ("ozone", "double"), ("nh3", "double"),
        ("temp_celsius", "double"), ("feels_like_celsius", "double"), ("humidity_pct", "double"),
        ("wind_speed_mps", "double"), ("wind_direction_degrees", "double"),
        ("weather_condition", "string"), ("rainfall_1h_mm", "double"), ("is_raining", "boolean"),
        ("wind_category", "string"), ("visibility_meters", "double"), ("pressure_hpa", "double"),
        ("weather_fetched_at", "timestamp"), ("has_weather_data", "boolean")])
    return spark.createDataFrame(data, schema)


def test_dominant_category_ties_smallest_label_and_null_first(spark):  # A4
    rows = [("A", "s1", 0, 10.0, 0.0, 1.0, "Poor"), ("A", "s2", 0, 10.0, 0.0, 1.0, "Good"),
            ("B", "s1", 0, 10.0, 0.0, 1.0, None), ("B", "s2", 0, 10.0, 0.0, 1.0, "Good"),
            ("C", "s1", 0, 10.0, 0.0, 1.0, "Good"), ("C", "s2", 0, 10.0, 0.0, 1.0, None),
            ("C", "s3", 0, 10.0, 0.0, 1.0, "Good")]
    got = {r.canonical_city: r.dominant_category for r in marts.city_trends(joined_frame(spark, rows)).collect()}
    assert got == {"A": "Good", "B": None, "C": "Good"}


def test_rain_windows_before_or_after_dropping_dry_rows(spark):  # R1
    rows = [("A", "s", h, comp, rain, 1.0, "Good") for h, comp, rain in
            [(0, 100.0, 0.0), (1, 10.0, 1.0), (2, 200.0, 0.0), (3, 30.0, 2.0), (4, 400.0, 0.0)]]
    j = joined_frame(spark, rows)
    rain = marts.rain_impact(j).first()
    assert rain.during_rain_avg_aqi == 20.0
    assert rain.pre_rain_avg_aqi == 10.0          # only the earlier rainy row
    assert rain.post_rain_6h_avg_aqi == 30.0
    allc = marts.rain_impact(j, context="all").first()
    assert allc.pre_rain_avg_aqi == pytest.approx((100.0 + (100 + 10 + 200) / 3) / 2)
    assert allc.rainfall_total_mm == 3.0


def test_features_hours_since_rain_trend_and_spike(spark):  # W8 W9 W10 P17 P18
    rows = [("A", "s", h, comp, rain, 1.0, "Good") for h, comp, rain in
            [(0, 10.0, 0.0), (1, 20.0, 0.0), (2, 30.0, 1.0), (3, 5.0, 0.0), (4, 350.0, 0.0), (5, 40.0, 0.0)]]
    feats = marts.city_features(joined_frame(spark, rows)).orderBy("reading_hour").collect()
    assert [r.hours_since_last_rain for r in feats] == [None, None, 0, 1, 2, 3]
    assert [r.pollution_trend for r in feats] == ["stable"] * 3 + ["falling", "rising", "rising"]
    assert [r.aqi_spike_flag for r in feats] == [0, 1, 1, 1, 0, 0]


def _random_frame(spark, n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        city = "HOT" if rnd.random() < 0.7 else rnd.choice(["A", "B", "C", None])
        rows.append((city, f"st{rnd.randrange(40)}", rnd.randrange(300),
                     rnd.uniform(0, 400), rnd.choice([0.0, 0.0, rnd.uniform(0, 3)]),
                     rnd.choice([None, rnd.uniform(0, 200)]), "Good"))
    df = joined_frame(spark, rows)
    return df.dropDuplicates(["canonical_city", "reading_hour", "station_name", "state"])


@pytest.mark.parametrize("block", [24, 31, 100])
def test_blocked_rows_window_equals_plain_window(spark, block):
    df = _random_frame(spark, 1500, seed=block).where("has_weather_data")
    base = df.select("canonical_city", "station_name", "state", "reading_hour", "composite_aqi",
                     "pm25", "rainfall_1h_mm", "wind_speed_mps")
    c = F.col("composite_aqi")
    rain_hour = F.when(F.col("rainfall_1h_mm") > 0, F.col("reading_hour"))
    specs = {
        "p3": rows_window.Frame("avg", F.col("pm25"), -2, 0),
        "p24": rows_window.Frame("avg", F.col("pm25"), -23, 0),
        "r6": rows_window.Frame("sum", F.col("rainfall_1h_mm"), -5, 0),
        "lag3": rows_window.Frame("lag", c, -3, -3),
        "next3": rows_window.Frame("max", c, 1, 3),
        "pre": rows_window.Frame("avg", c, -3, -1),
        "post6": rows_window.Frame("avg", c, 1, 6),
        "last_rain": rows_window.Frame("max", rain_hour, None, 0),
        "cum_rain": rows_window.Frame("sum", F.col("rainfall_1h_mm"), None, 0),
    }
    order = marts.CITY_ROW_ORDER
    key = ["canonical_city", "reading_hour", "station_name", "state"]

    def rows(df_):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                       for r in df_.select(*key, *specs).collect()),
                      key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))

    plain = rows(rows_window.over_rows(base, "canonical_city", order, specs, block_rows=0))
    blocked = rows(rows_window.over_rows(base, "canonical_city", order, specs, block_rows=block))
    assert len(plain) == base.count()
    assert plain == blocked


def test_hours_mode_matches_range_windows_on_rows(spark):
    df = _random_frame(spark, 600, seed=7)
    got = marts.city_features(df, by="hours")
    assert got.count() == df.count()


def test_leaderboard_rank_and_day_counts(spark):  # A8 A9 W3
    trends = spark.createDataFrame(
        [("A", dt.date(2024, 1, d), v, cat) for d, v, cat in [(1, 10.0, "Good"), (2, 30.0, "Severe")]]
        + [("B", dt.date(2024, 1, 1), 20.0, "Good"), ("C", dt.date(2024, 1, 1), 50.0, "Poor")],
        "canonical_city string, reading_date date, avg_aqi double, dominant_category string")
    got = {r.canonical_city: r for r in marts.city_leaderboard(trends).collect()}
    assert got["A"].aqi_rank == 1 and got["B"].aqi_rank == 1 and got["C"].aqi_rank == 3
    assert got["A"].days_good == 1 and got["A"].days_severe == 1 and got["A"].worst_day_aqi == 30.0


def test_quality_metrics_with_no_rows(spark):  # H1
    stg = spark.createDataFrame([], "reading_hour timestamp, latest_fetched_at timestamp, pm25 double, pm10 double")
    wx = spark.createDataFrame([], "weather_hour timestamp, fetched_at timestamp")
    bad = spark.createDataFrame([], schemas.INVALID_RECORDS)
    m = quality.quality_metrics(stg, wx, bad, "2024-01-01 00:00:00").first()
    assert m.aqi_rows_last_hour == 0 and m.freshness_minutes == 0 and m.is_aqi_low_volume
    assert m.null_pm25_rate is None and m.is_pm25_data_missing is None


def test_checks_report_failures(spark):  # Q2 Q3 Q4
    cat = spark.createDataFrame(
        [(H, -1.0, "Good"), (H, 5.0, "Bogus"), (H, 5.0, None), (H + dt.timedelta(days=9), 1.0, "Good")],
        "reading_hour timestamp, composite_aqi double, aqi_category string")
    rep = {r.test_name: (r.failures, r.status) for r in quality.category_checks(cat, "2024-01-01 12:00:00").collect()}
    assert rep["valid_aqi_category"] == (1, "fail")   # NULL passes
    assert rep["aqi_positive"] == (1, "fail")
    assert rep["no_future_timestamps"] == (1, "fail")
    assert rep["not_null_composite_aqi"] == (0, "pass")


def test_weather_epoch_columns_decode_like_readings(spark):  # Z2 for weather
    us = int(H.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    raw = spark.createDataFrame(
        [("Pune", us * 1000, 20.0, us // 1000 + 3_600_000)],
        "city string, recorded_at long, temp_celsius double, fetched_at long")
    for c, t in [("feels_like_celsius", "double"), ("humidity_pct", "double"), ("wind_speed_mps", "double"),
                 ("wind_direction_degrees", "double"), ("weather_condition", "string"),
                 ("rainfall_1h_mm", "double"), ("visibility_meters", "double"), ("pressure_hpa", "double")]:
        raw = raw.withColumn(c, F.lit(None).cast(t))
    r = staging.stg_weather(raw, seeds.default_city_map(spark)).select(
        F.col("weather_hour").cast("timestamp_ntz").alias("h"),
        F.col("fetched_at").cast("timestamp_ntz").alias("f")).first()
    assert r.h == H and r.f == H + dt.timedelta(hours=1)


def test_city_alias_trim_removes_any_white_space(spark):  # J1
    rows = [("S1", "\tBombay\n", "MH", "CO", 1.0, US), ("S2", " Pune　", "MH", "CO", 1.0, US)]
    stg = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark))
    assert {r.station_name: r.canonical_city for r in stg.collect()} == {"S1": "Mumbai", "S2": "Pune"}


def test_row_index_is_dense_and_blocks_are_bounded(spark):
    df = _random_frame(spark, 1200, seed=11).select("canonical_city", "reading_hour", "station_name", "state")
    idx = rows_window.row_index(df, "canonical_city", marts.CITY_ROW_ORDER)
    per_key = idx.groupBy("canonical_city").agg(
        F.count(F.lit(1)).alias("n"), F.min("_idx").alias("lo"), F.max("_idx").alias("hi"),
        F.countDistinct("_idx").alias("d")).collect()
    assert all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in per_key)
    hot = max(r.n for r in per_key)
    assert hot > 500  # one city holds most rows
    # the window partitions of the blocked evaluation: home rows + boundary copies
    b, back, ahead = 50, 23, 6
    spread = rows_window.spread_blocks(idx, b, back, ahead)
    sizes = spread.groupBy("canonical_city", "_blk").count().agg(F.max("count")).first()[0]
    assert sizes <= b + back + ahead
    assert spread.where("_home").count() == idx.count()


def test_operators_pin_the_session_time_zone(spark):  # Z1
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        ist_0600 = dt.datetime(2024, 1, 2, 0, 30, tzinfo=dt.timezone.utc)
        rows = [("S1", "Pune", "MH", "CO", 1.0, int(ist_0600.timestamp()))]
        r = staging.stg_readings(raw_aqi(spark, rows), seeds.default_city_map(spark)).select(
            F.col("reading_hour").cast("timestamp_ntz").alias("h"), "reading_date").first()
        assert r.h == dt.datetime(2024, 1, 2, 0, 0) and r.reading_date == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_global_rank_equals_rank_window_with_ties_and_nulls(spark):  # W3
    from pyspark.sql import Window
    rnd = random.Random(5)
    rows = [(f"c{i}", rnd.choice([None, 1.0, 2.0, 2.0, -3.5, 0.0, -0.0, 1e-9, -1e300, float("inf"), float("-inf"), float("nan"), float(rnd.randrange(50)), rnd.random() * 500])) for i in range(300)]
    df = spark.createDataFrame(rows, "canonical_city string, v double")
    want = {r.canonical_city: r.rk for r in df.select(
        "canonical_city", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first())).alias("rk")).collect()}
    got = {r.canonical_city: r.rk for r in
           rows_window.global_rank(df, "v", "rk").collect()}
    assert got == want


def test_blocked_window_and_rank_on_empty_input(spark):
    empty = spark.createDataFrame([], "canonical_city string, reading_hour timestamp, station_name string, "
                                      "state string, composite_aqi double")
    specs = {"lag3": rows_window.Frame("lag", F.col("composite_aqi"), -3, -3),
             "run": rows_window.Frame("max", F.col("composite_aqi"), None, 0)}
    assert rows_window.over_rows(empty, "canonical_city", marts.CITY_ROW_ORDER, specs, block_rows=30).count() == 0
    assert rows_window.over_rows(empty, "canonical_city", marts.CITY_ROW_ORDER, specs).count() == 0
    assert rows_window.global_rank(empty, "composite_aqi", "rk").count() == 0


def test_numbering_starts_no_job_and_orders_ties_by_the_other_columns(spark):  # W3-W14
    df = _random_frame(spark, 400, seed=3).where("has_weather_data").select(
        "canonical_city", "station_name", "state", "reading_hour", "composite_aqi", "pm25")
    twice = df.unionByName(df.withColumn("pm25", F.lit(-1.0)))  # ties in every order column
    specs = {"below": rows_window.Frame("max", F.col("composite_aqi"), None, -1),
             "prev": rows_window.Frame("lag", F.col("pm25"), -1, -1)}
    sc = spark.sparkContext
    sc.setJobGroup("build", "building the query")
    try:
        built = rows_window.over_rows(twice, "canonical_city", marts.CITY_ROW_ORDER, specs, block_rows=30)
        rows_window.global_rank(df, "composite_aqi", "rk")
        assert not sc.statusTracker().getJobIdsForGroup("build")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    plain = rows_window.over_rows(twice, "canonical_city", [*marts.CITY_ROW_ORDER, "composite_aqi", "pm25"], specs, block_rows=0)

    def rows(d):
        return sorted(map(repr, (tuple(r) for r in d.collect())))

    assert rows(built) == rows(plain)
    assert rows(built) == rows(built.repartition(7).coalesce(1).select(built.columns))
