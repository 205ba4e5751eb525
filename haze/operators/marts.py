"""Marts: daily trends, pollutant breakdown, weather correlation, rain impact,
city leaderboard and the hourly feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haze import schemas
from haze.functions.exprs import first_max_label, safe_corr, whole_units_between
from haze.operators import rows_window
from haze.session import ensure_utc, scratch_path


# Deterministic order of the station rows of one city (several stations share
# an hour; ROWS frames need a total order).
CITY_ROW_ORDER = ["reading_hour", "station_name", "state"]


def city_trends(joined: DataFrame) -> DataFrame:
    """Per city and day: avg/max/min composite, avg pm25/pm10 and the dominant
    category (most rows; ties -> smallest label, NULL first).

    Two hash aggregations of fixed-width state: per city, day and category, then
    per city and day. Map tasks combine their rows before either shuffle, and
    the second one sees a few rows per city and day.
    """
    measures = {"aqi": "composite_aqi", "pm25": "pm25", "pm10": "pm10"}
    by_category = joined.groupBy("canonical_city", "reading_date", "aqi_category").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("composite_aqi").alias("_max"), F.min("composite_aqi").alias("_min"),
        *(F.sum(c).alias(f"_sum_{k}") for k, c in measures.items()),
        *(F.count(c).alias(f"_count_{k}") for k, c in measures.items()))
    average = lambda k: F.try_divide(F.sum(f"_sum_{k}"), F.sum(f"_count_{k}")).alias(f"avg_{k}")
    label = F.col("aqi_category")
    return by_category.groupBy("canonical_city", "reading_date").agg(
        average("aqi"), F.max("_max").alias("max_aqi"), F.min("_min").alias("min_aqi"),
        average("pm25"), average("pm10"),
        F.min(F.struct(-F.col("_n"), label.isNotNull(), label.alias("label"))).getField("label").alias("dominant_category"))


def pollutant_breakdown(cat: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    """Per city and day: average of each pollutant and of the composite, and the
    name of the pollutant with the highest average.

    By default a day with any all-NULL pollutant gets 'NH3' (strict GREATEST
    makes every comparison fail); ``ignore_nulls=True`` compares the present
    averages only.
    """
    avgs = [F.avg(c).alias(f"avg_{c}") for c in schemas.POLLUTANT_COLUMNS]
    base = cat.groupBy("canonical_city", "reading_date").agg(
        *avgs, F.avg("composite_aqi").alias("avg_composite_aqi"))
    labeled = [(label, f"avg_{c}") for c, label, _ in schemas.POLLUTANTS]
    return base.withColumn("dominant_pollutant", first_max_label(labeled, ignore_nulls))


def weather_correlation(joined: DataFrame) -> DataFrame:
    """Per city: Pearson correlation of the composite with wind, humidity,
    temperature and rain, over station-hours that have weather."""
    pairs = [("wind_speed_mps", "wind_aqi_correlation"),
             ("humidity_pct", "humidity_aqi_correlation"),
             ("temp_celsius", "temp_aqi_correlation"),
             ("rainfall_1h_mm", "rain_aqi_correlation")]
    return joined.where(F.col("has_weather_data")).groupBy("canonical_city").agg(
        *[safe_corr("composite_aqi", x).alias(name) for x, name in pairs],
        F.count(F.lit(1)).alias("data_points_used"),
    )


def rain_impact(joined: DataFrame, context: str = "rain", block_rows: int | None = None) -> DataFrame:
    """Per city and rainy day: composite before / during / after rain.

    ``context="rain"`` (default) drops dry rows first, so "before" means the
    three previous rainy rows of the city; ``context="all"`` evaluates the
    windows over every row and keeps the rainy ones afterwards.
    """
    if context not in ("rain", "all"):
        raise ValueError("context must be 'rain' or 'all'")
    ensure_utc(joined.sparkSession)
    base = joined.where(F.col("has_weather_data")).select(
        "canonical_city", "station_name", "state", "reading_hour",
        F.to_date("reading_hour").alias("rain_event_date"),
        "composite_aqi", "rainfall_1h_mm", "is_raining",
    )
    if context == "rain":
        base = base.where(F.col("is_raining"))
    c = F.col("composite_aqi")
    specs = {
        "pre_rain_avg_aqi": rows_window.Frame("avg", c, -3, -1),
        "during_rain_avg_aqi": rows_window.Frame("avg", c, 0, 0),
        "post_rain_1h_avg_aqi": rows_window.Frame("avg", c, 1, 1),
        "post_rain_6h_avg_aqi": rows_window.Frame("avg", c, 1, 6),
    }
    events = rows_window.over_rows(base, "canonical_city", CITY_ROW_ORDER, specs,
                                   block_rows=block_rows)
    if context == "all":
        events = events.where(F.col("is_raining"))
    return events.groupBy("canonical_city", "rain_event_date").agg(
        F.avg("pre_rain_avg_aqi").alias("pre_rain_avg_aqi"),
        F.avg("during_rain_avg_aqi").alias("during_rain_avg_aqi"),
        F.avg("post_rain_1h_avg_aqi").alias("post_rain_1h_avg_aqi"),
        F.avg("post_rain_6h_avg_aqi").alias("post_rain_6h_avg_aqi"),
        (F.avg("pre_rain_avg_aqi") - F.avg("post_rain_6h_avg_aqi")).alias("aqi_improvement"),
        F.sum("rainfall_1h_mm").alias("rainfall_total_mm"),
    )


def city_leaderboard(trends: DataFrame) -> DataFrame:
    """Per city: overall/worst/best daily average, good and severe day counts,
    and the rank of the overall average (1 = cleanest, ties share a rank).

    The rank is computed without a single-task global window
    (``rows_window.global_rank``). It needs each city's average twice, and averages
    of doubles may differ in the last bit when they are computed again, so the
    table of cities is written once to the shared scratch folder.
    """
    per_city = trends.groupBy("canonical_city").agg(
        F.avg("avg_aqi").alias("overall_avg_aqi"),
        F.max("avg_aqi").alias("worst_day_aqi"),
        F.min("avg_aqi").alias("best_day_aqi"),
        F.count_if(F.col("dominant_category") == "Good").alias("days_good"),
        F.count_if(F.col("dominant_category") == "Severe").alias("days_severe"),
    )
    path = scratch_path(trends.sparkSession, "leaderboard")
    per_city.write.parquet(path)
    ranked = rows_window.global_rank(trends.sparkSession.read.parquet(path), "overall_avg_aqi", "aqi_rank")
    return ranked.select("canonical_city", "overall_avg_aqi", "worst_day_aqi", "best_day_aqi",
                         "days_good", "days_severe", F.col("aqi_rank").cast("int").alias("aqi_rank"))


def city_features(joined: DataFrame, by: str = "rows", block_rows: int | None = None) -> DataFrame:
    """Hourly feature table per city (rows with weather only).

    ``by="rows"`` (default): every "last n hours" feature is the last n rows of
    the city in (hour, station, state) order, as the source defines them.
    ``by="hours"``: frames are real clock ranges over the reading hour.

    With a column ``carry_rain`` (newest rain hour before the row's date) the
    rows may be a part of the history: "hours since last rain" goes on from it.
    """
    carried = ["carry_rain"] if "carry_rain" in joined.columns else []
    base = joined.where(F.col("has_weather_data")).select(
        "canonical_city", "station_name", "state", "reading_hour", "composite_aqi",
        "pm25", "rainfall_1h_mm", "wind_speed_mps", *carried)
    rain_hour = F.when(F.col("rainfall_1h_mm") > 0, F.col("reading_hour"))
    c = F.col("composite_aqi")
    if by == "rows":
        specs = {
            "avg_pm25_last_3h": rows_window.Frame("avg", F.col("pm25"), -2, 0),
            "avg_pm25_last_24h": rows_window.Frame("avg", F.col("pm25"), -23, 0),
            "rainfall_last_6h": rows_window.Frame("sum", F.col("rainfall_1h_mm"), -5, 0),
            "wind_speed_last_3h": rows_window.Frame("avg", F.col("wind_speed_mps"), -2, 0),
            "_lag3": rows_window.Frame("lag", c, -3, -3),
            "_next3_max": rows_window.Frame("max", c, 1, 3),
            "_last_rain": rows_window.Frame("max", rain_hour, None, 0),
        }
        feats = rows_window.over_rows(base, "canonical_city", CITY_ROW_ORDER, specs,
                                      block_rows=block_rows)
    elif by == "hours":
        feats = _hour_range_features(base, rain_hour)
    else:
        raise ValueError("by must be 'rows' or 'hours'")
    if carried:
        feats = feats.withColumn("_last_rain", F.greatest("_last_rain", "carry_rain"))
    trend = (F.when(c > F.col("_lag3"), "rising")
             .when(c < F.col("_lag3"), "falling").otherwise("stable"))
    return feats.select(
        "canonical_city", "reading_hour", "composite_aqi",
        "avg_pm25_last_3h", "avg_pm25_last_24h", "rainfall_last_6h", "wind_speed_last_3h",
        trend.alias("pollution_trend"),
        whole_units_between("HOUR", F.col("_last_rain"), F.col("reading_hour"))
        .alias("hours_since_last_rain"),
        F.when(F.col("_next3_max") > 300, 1).otherwise(0).alias("aqi_spike_flag"),
    )


def _hour_range_features(base: DataFrame, rain_hour: Column) -> DataFrame:
    """Clock-range variant: "last n hours" are the readings of the city whose
    hour lies in [hour - (n-1), hour]; the 3-hour trend compares with the
    city's highest composite exactly three hours earlier.

    Rows are first reduced to one row per city-hour (sums, counts, maxima,
    combined map-side), so the window runs over a series whose length is the
    number of hours, whatever the number of stations or rows; the features
    are joined back to the station rows on (city, hour).
    """
    hourly = base.groupBy("canonical_city", "reading_hour").agg(
        F.sum("pm25").alias("_s_pm25"), F.count("pm25").alias("_n_pm25"),
        F.sum("rainfall_1h_mm").alias("_s_rain"),
        F.sum("wind_speed_mps").alias("_s_wind"), F.count("wind_speed_mps").alias("_n_wind"),
        F.max("composite_aqi").alias("_max_c"), F.max(rain_hour).alias("_rain_h"))
    w = Window.partitionBy("canonical_city").orderBy(F.unix_seconds("reading_hour"))
    h = 3600

    def ratio(s: str, n: str, lo: int) -> Column:
        frame = w.rangeBetween(lo * h, 0)
        return F.try_divide(F.sum(s).over(frame), F.sum(n).over(frame))

    feats = hourly.select(
        "canonical_city", "reading_hour",
        ratio("_s_pm25", "_n_pm25", -2).alias("avg_pm25_last_3h"),
        ratio("_s_pm25", "_n_pm25", -23).alias("avg_pm25_last_24h"),
        F.sum("_s_rain").over(w.rangeBetween(-5 * h, 0)).alias("rainfall_last_6h"),
        ratio("_s_wind", "_n_wind", -2).alias("wind_speed_last_3h"),
        F.max("_max_c").over(w.rangeBetween(-3 * h, -3 * h)).alias("_lag3"),
        F.max("_max_c").over(w.rangeBetween(1 * h, 3 * h)).alias("_next3_max"),
        F.max("_rain_h").over(w.rangeBetween(Window.unboundedPreceding, 0)).alias("_last_rain"),
    )
    feats = feats.withColumnRenamed("canonical_city", "_k").withColumnRenamed("reading_hour", "_h")
    cond = base["canonical_city"].eqNullSafe(feats["_k"]) & (base["reading_hour"] == feats["_h"])
    return base.join(feats, cond, "inner").drop("_k", "_h")
