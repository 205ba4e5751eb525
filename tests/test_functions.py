"""Column helpers: epoch units, numeric and datetime parsing, labels, corr."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from haze.functions import exprs


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_epoch_units_decode_to_the_same_instant(spark):  # Z2
    us = 1704067200123456
    vals = [us // 1_000_000, us // 1000, us, us * 1000, None]
    out = _one(spark, exprs.epoch_to_timestamp("x").cast("timestamp_ntz"), [(v,) for v in vals], "x long")
    assert out[0] == dt.datetime(2024, 1, 1, 0, 0, 0)
    assert out[1] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert out[2] == out[3] == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    assert out[4] is None


def test_nanoseconds_round_half_away_from_zero(spark):
    out = _one(spark, exprs.epoch_to_timestamp("x").cast("timestamp_ntz"),
               [(1704067200000000500,), (1704067200000000499,)], "x long")
    assert out[0] == dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    assert out[1] == dt.datetime(2024, 1, 1, 0, 0, 0, 0)


def test_safe_double_follows_python_float_except_underscores(spark):
    texts = [" 12.5 ", "1e2", "-3", "nan", "NaN", "inf", "-Infinity", "\t7\n", ".5", "5.",
             "NA", "", "12d", "0x10", "1_000", "1.2.3", None]
    out = _one(spark, exprs.safe_double("s"), [(t,) for t in texts], "s string")
    for text, got in zip(texts, out):
        if text is None or text == "1_000":
            assert got is None
            continue
        try:
            want = float(text.strip())
        except ValueError:
            want = None
        if want is None:
            assert got is None, text
        elif math.isnan(want):
            assert math.isnan(got), text
        else:
            assert got == want, text


def test_local_datetime_formats_and_offset(spark):  # N5, Z1
    texts = ["06/03/2024 06:00:00", "06-03-2024 06:00:00", "2024-03-06 06:00:00",
             " 6/3/2024 6:0:0 ", "6/3/2024  6:00:00", "31/02/2024 00:00:00", "2024/03/06 06:00", None]
    out = _one(spark, exprs.parse_local_datetime("s").cast("timestamp_ntz"), [(t,) for t in texts], "s string")
    want = dt.datetime(2024, 3, 6, 0, 30)  # 06:00 at UTC+05:30
    assert out[:5] == [want] * 5
    assert out[5:] == [None, None, None]


def test_wind_category_null_is_strong(spark):  # P8
    out = _one(spark, exprs.wind_category("w"), [(0.0,), (2.0,), (4.9,), (9.99,), (10.0,), (None,)], "w double")
    assert out == ["Calm", "Light", "Light", "Moderate", "Strong", "Strong"]


def test_first_max_label_strict_and_ignore_nulls(spark):  # G1
    data = [(1.0, 3.0, 2.0), (None, 3.0, 2.0), (5.0, 5.0, 1.0), (None, None, None)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    labeled = [("A", "a"), ("B", "b"), ("C", "c")]
    strict = [r[0] for r in df.select(exprs.first_max_label(labeled)).collect()]
    loose = [r[0] for r in df.select(exprs.first_max_label(labeled, ignore_nulls=True)).collect()]
    assert strict == ["B", "C", "A", "C"]
    assert loose == ["B", "B", "A", "C"]


def test_safe_corr_matches_numpy_and_nulls_degenerate_cases(spark):  # A6
    rng = np.random.default_rng(3)
    xs, ys = rng.normal(size=50), rng.normal(size=50)
    rows = [("a", float(x), float(y)) for x, y in zip(xs, ys)]
    rows += [("a", None, 1.0), ("a", 2.0, None)]  # pairs with a NULL side are ignored
    rows += [("const", 1.0, float(i)) for i in range(5)]
    rows += [("single", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: r.c for r in df.groupBy("k").agg(exprs.safe_corr("x", "y").alias("c")).collect()}
    assert abs(got["a"] - np.corrcoef(xs, ys)[0, 1]) < 1e-12
    assert got["const"] is None and got["single"] is None


def test_composite_index_reads_null_as_zero(spark):
    df = spark.createDataFrame([(None, None), (3.0, None), (-1.0, None)], "a double, b double")
    out = [r[0] for r in df.select(exprs.composite_index(["a", "b"])).collect()]
    assert out == [0.0, 3.0, 0.0]


def test_whole_hours_truncate(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 2, 59))],
                               "a timestamp, b timestamp")
    assert df.select(exprs.whole_units_between("HOUR", F.col("a"), F.col("b"))).first()[0] == 2


def test_scale_settings_bounds():
    from haze.session import scale_settings
    assert scale_settings(0)["spark.sql.shuffle.partitions"] == "200"
    assert scale_settings(100 * 2**40)["spark.sql.shuffle.partitions"] == "409600"
    assert scale_settings(1000 * 2**30)["spark.sql.shuffle.partitions"] == "4000"
