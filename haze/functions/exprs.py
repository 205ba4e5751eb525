"""Column -> Column helpers. All are built-in Spark expressions (codegen'd, no UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Epoch magnitude thresholds that decide the unit of an integer
# timestamp (>= 1e17 nanoseconds, >= 1e14 microseconds, >= 1e11 milliseconds,
# else seconds).
NANOS_FROM = 100_000_000_000_000_000
MICROS_FROM = 100_000_000_000_000
MILLIS_FROM = 100_000_000_000

# Accepted local datetime layouts, tried in this order, and the
# fixed offset of the source's local time (UTC+05:30).
LOCAL_DATETIME_PATTERNS = ["d/M/yyyy H:m:s", "d-M-yyyy H:m:s", "yyyy-M-d H:m:s"]
LOCAL_UTC_OFFSET = "+05:30"

# A decimal or scientific literal (what Python's float() accepts, minus digit
# group underscores); nan/inf/infinity spellings (any case, optional sign) are
# mapped separately because a cast accepts only some of them.
_NUMERIC_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(c: ColumnOrName, n: int) -> Column:
    """Exact integer division of a long (SQL ``div``), no detour through double."""
    return F.call_function("div", _col(c), F.lit(n))


def epoch_to_timestamp(c: ColumnOrName) -> Column:
    """Integer epoch of unknown unit -> TIMESTAMP (s, ms, µs or ns by magnitude).

    Nanoseconds are rounded half away from zero to microseconds, like a cast of
    the quotient to an integer. Values beyond any instant are NULL.
    """
    x = _col(c).cast("long")
    return (
        F.when(x.isNull() | (x < -MILLIS_FROM) | (x > 2**63 - 501), F.lit(None).cast("timestamp"))
        .when(x >= NANOS_FROM, F.timestamp_micros(int_div(x + 500, 1000)))
        .when(x >= MICROS_FROM, F.timestamp_micros(x))
        .when(x >= MILLIS_FROM, F.timestamp_millis(x))
        .otherwise(F.timestamp_seconds(x))
    )


def to_instant(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Timestamp columns pass through; integer epochs are decoded by magnitude."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _col(c).cast("timestamp")
    return epoch_to_timestamp(c)


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace: any Unicode white space (tabs,
    newlines, no-break spaces...), not only the spaces Spark's ``trim`` drops."""
    return F.regexp_replace(_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


def safe_double(c: ColumnOrName) -> Column:
    """Text -> double, NULL when the stripped text is not a number.

    Guarded by a pattern so that Java-only spellings (``12d``, ``0x1p3``) and
    digit-group underscores are rejected instead of silently accepted.
    """
    s = strip_ws(c)
    low = F.lower(s)
    return (F.when(s.rlike(_NUMERIC_RE), s.try_cast("double"))
            .when(low.rlike(r"^[+-]?nan$"), F.lit(float("nan")))
            .when(low.rlike(r"^-inf(inity)?$"), F.lit(float("-inf")))
            .when(low.rlike(r"^[+]?inf(inity)?$"), F.lit(float("inf"))))


def as_double(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Numeric columns pass through; text is parsed with ``safe_double``."""
    if isinstance(dtype, T.NumericType):
        return _col(c).cast("double")
    return safe_double(c)


def parse_local_datetime(c: ColumnOrName,
                         patterns: Sequence[str] = LOCAL_DATETIME_PATTERNS,
                         utc_offset: str = LOCAL_UTC_OFFSET) -> Column:
    """Local wall-clock text -> UTC instant; NULL when no pattern fits.

    The text is stripped and inner whitespace runs collapse to one space; the
    one-letter fields accept one or two digits.
    """
    s = F.regexp_replace(strip_ws(c), r"(?U)\s+", " ")
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in patterns])
    return F.to_utc_timestamp(parsed, utc_offset)


def composite_index(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise maximum with NULL read as 0."""
    return F.greatest(*[F.coalesce(_col(c), F.lit(0.0)) for c in cols])


def first_max_label(values: Sequence[tuple[str, ColumnOrName]],
                    ignore_nulls: bool = False) -> Column:
    """Label of the first column equal to the row maximum; the last label is
    the ELSE branch (returned also when nothing matches).

    With ``ignore_nulls=False`` any NULL makes the maximum NULL (strict
    GREATEST), so every comparison fails and the last label is returned.
    With ``ignore_nulls=True`` Spark's GREATEST (which skips NULLs) is used.
    """
    labels = [n for n, _ in values]
    cols = [_col(v) for _, v in values]
    top = F.greatest(*cols)
    if not ignore_nulls:
        any_null = cols[0].isNull()
        for c in cols[1:]:
            any_null = any_null | c.isNull()
        top = F.when(~any_null, top)
    expr = F.when(cols[0] == top, F.lit(labels[0]))
    for label, c in zip(labels[1:-1], cols[1:-1]):
        expr = expr.when(c == top, F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


# Wind speed classes (m/s, upper bounds exclusive); NULL speed
# falls through to the last class.
WIND_CLASSES = [(2, "Calm"), (5, "Light"), (10, "Moderate")]
WIND_TOP_CLASS = "Strong"


def wind_category(c: ColumnOrName) -> Column:
    c = _col(c)
    expr = None
    for bound, label in WIND_CLASSES:
        expr = F.when(c < bound, label) if expr is None else expr.when(c < bound, label)
    return expr.otherwise(WIND_TOP_CLASS)


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation aggregate; NULL for fewer than 2 pairs or zero variance.

    Built from covariance and standard deviations over the pairs where both
    sides are non-NULL (what CORR uses), with ``try_divide`` instead of the
    division that raises under ANSI mode when a side is constant.
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def whole_units_between(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole ``unit``s from ``start`` to ``end`` (truncated, like TIMESTAMP_DIFF)."""
    return F.timestamp_diff(unit, _col(start), _col(end))
