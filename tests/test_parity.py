"""Property tests of the Column parsers against generated values."""

import calendar
import datetime as dt
import math

from hypothesis import given, settings, strategies as st

from haze.functions import exprs

LOCAL_MINUTES = 330  # fixed value: source stamps are UTC+05:30

# Text -> number by hand; None: not numeric.
NUMBERS = [
    ("0", 0.0), ("7", 7.0), ("007", 7.0), ("-3", -3.0), ("+4", 4.0), ("12.5", 12.5), (" 12.5 ", 12.5), ("\t9\n", 9.0), (".5", 0.5), ("5.", 5.0),
    ("1e2", 100.0), ("1E-2", 0.01), ("1.e3", 1000.0), ("-1.5e+1", -15.0), ("nan", math.nan), ("NaN", math.nan), ("-nan", math.nan),
    ("inf", math.inf), ("-Infinity", -math.inf), ("+INF", math.inf), ("1e400", math.inf), ("", None), (" ", None), (".", None), ("-", None),
    ("e5", None), ("1e", None), ("1 2", None), ("12d", None), ("12f", None), ("0x10", None), ("1_000", None), ("1,000", None), ("NA", None),
    ("in", None), ("infin", None), ("--1", None), ("1.2.3", None), ("+-1", None), ("1e2.5", None),
]


def test_safe_double_on_written_numbers(spark):
    rows = spark.createDataFrame([(t,) for t, _ in NUMBERS], "s string").select(exprs.safe_double("s")).collect()
    for (text, want), (value,) in zip(NUMBERS, rows):
        if want is not None and math.isnan(want):
            assert value is not None and math.isnan(value), repr(text)
        else:
            assert value == want, repr(text)


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(0, 999), st.sampled_from(["", " ", "\t"])), min_size=30, max_size=60))
def test_safe_double_reads_back_what_was_written(spark, parts):
    texts = [(f"{pad}{n}.{frac:03d}{pad}", (abs(n) * 1000 + frac) / 1000 * (-1 if n < 0 else 1)) for n, frac, pad in parts]
    rows = spark.createDataFrame([(t,) for t, _ in texts], "s string").select(exprs.safe_double("s")).collect()
    assert [r[0] for r in rows] == [v for _, v in texts]


# Layouts of a stamp: separator, year first, accepted.
LAYOUTS = [("/", False, True), ("-", False, True), ("-", True, True), ("/", True, False)]
stamps = st.tuples(st.integers(1900, 2100), st.integers(1, 13), st.integers(1, 32), st.integers(0, 24), st.integers(0, 60), st.integers(0, 60),
                   st.sampled_from([1, 2]), st.sampled_from(LAYOUTS), st.sampled_from(["", " ", "  "]), st.sampled_from([" ", "  "]))


def _written(y, mo, d, h, mi, sec, width, layout, pad, gap):
    """(text, expected UTC instant or None), both from the generated fields."""
    sep, year_first, accepted = layout
    day = [f"{y:04d}", f"{mo:0{width}d}", f"{d:0{width}d}"]
    text = pad + sep.join(day if year_first else day[::-1]) + gap + ":".join(f"{x:0{width}d}" for x in (h, mi, sec)) + pad
    in_month = 1 <= mo <= 12 and d <= calendar.monthrange(y, mo)[1]
    if not (accepted and in_month and h < 24 and mi < 60 and sec < 60):
        return text, None
    minutes = (dt.date(y, mo, d).toordinal() * 24 + h) * 60 + mi - LOCAL_MINUTES
    return text, dt.datetime.fromordinal(minutes // 1440) + dt.timedelta(minutes=minutes % 1440, seconds=sec)


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(stamps, min_size=40, max_size=100))
def test_local_datetime_from_generated_fields(spark, fields):
    cases = [_written(*f) for f in fields]
    rows = (spark.createDataFrame([(t,) for t, _ in cases], "s string")
            .select(exprs.parse_local_datetime("s").cast("timestamp_ntz")).collect())
    for (text, want), (value,) in zip(cases, rows):
        assert value == want, (text, value, want)
