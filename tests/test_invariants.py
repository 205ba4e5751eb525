"""Invariants on the driver's sf0.01 tables."""

from pyspark.sql import functions as F

from conftest import SF_MID
from haze import schemas
from haze.plans.catalog import Models


def test_pivot_conserves_the_per_group_max(spark):
    m = Models(spark, SF_MID)
    stg = m.stg
    # the same max computed the long way: one group per (keys, column)
    long = (m.raw_aqi.where("pollutant_avg > 0 and not isnan(pollutant_avg)")
            .withColumn("_pid", F.upper("pollutant_id")))
    for col, _, aliases in schemas.POLLUTANTS:
        want = long.where(F.col("_pid").isin(*aliases)).agg(F.max("pollutant_avg")).first()[0]
        got = stg.agg(F.max(col)).first()[0]
        assert got == want, col
    assert stg.count() == stg.select("station_name", "canonical_city", "state", "reading_hour").distinct().count()


def test_weather_dedup_key_unique_and_join_does_not_fan_out(spark):
    m = Models(spark, SF_MID)
    wx = m.wx
    assert wx.count() == wx.select("canonical_city", "weather_hour").distinct().count()
    assert m.joined.count() == m.cat.count() == m.stg.count()
    with_wx = m.joined.where("has_weather_data").count()
    assert 0 < with_wx < m.joined.count()  # some station-hours have no weather


def test_every_category_row_is_labelled_or_reported(spark):
    m = Models(spark, SF_MID)
    labelled = m.cat.where(F.col("aqi_category").isin(*schemas.CATEGORIES)).count()
    cov = m.cat.agg(F.count_if(F.col("aqi_category").isNull()).alias("n")).first().n
    assert labelled + cov == m.cat.count()
