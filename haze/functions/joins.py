"""Join helpers: size-checked broadcast and a range (BETWEEN) lookup join."""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lookups above these sizes are not broadcast; the planner (and AQE, which sees
# real shuffle sizes) chooses the join strategy instead.
BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 32 << 20
# A nested-loop range join compares every row with every range.
NESTED_MAX_RANGES = 1_000


_checked: "weakref.WeakKeyDictionary[DataFrame, dict[int, bool]]" = weakref.WeakKeyDictionary()


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of at most ``max_bytes``
    together (their text as JSON, which is no shorter than their values).

    The probe reads at most ``max_rows + 1`` rows, so it stays cheap even when
    the frame turns out to be large. The answer is remembered for this
    DataFrame object (whose input files are fixed when it is created).
    """
    seen = _checked.setdefault(df, {})
    if max_rows not in seen:
        rows, size = (df.limit(max_rows + 1).select(F.octet_length(F.to_json(F.struct("*"))).alias("b"))
                      .agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first())
        seen[max_rows] = rows <= max_rows and size <= max_bytes
    return seen[max_rows]


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def range_lookup(left: DataFrame, value: Column, ranges: DataFrame, lo: str, hi: str,
                 how: str = "left", max_rows: int = NESTED_MAX_RANGES,
                 bucket_width: float | None = None, small: bool | None = None) -> DataFrame:
    """``left JOIN ranges ON value BETWEEN ranges.lo AND ranges.hi``.

    Small range tables are broadcast (a nested-loop join whose build side is
    the range table, never the fact side). A large range table is joined on a
    bucket key instead: each range is exploded into the fixed-width buckets it
    covers and the fact row probes its own bucket, then the exact BETWEEN is
    applied, so the join is a shuffle equi-join with no cross product. By
    default a bucket is as wide as the widest range, which then covers two
    buckets at most.
    ``small`` passes a size decision already made for the range table.
    """
    if small is None:
        small = fits_broadcast(ranges, max_rows)
    if small:
        return left.join(F.broadcast(ranges), value.between(F.col(lo), F.col(hi)), how)
    if bucket_width is None:
        bucket_width = ranges.agg(F.max(F.col(hi) - F.col(lo)).cast("double")).first()[0]
    w = float(bucket_width or 0) or 1.0
    bucketed = ranges.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col(lo) / w).cast("long"),
                             F.floor(F.col(hi) / w).cast("long"))),
    )
    probe = left.withColumn("_bucket", F.floor(value / w).cast("long"))
    cond = (probe["_bucket"] == bucketed["_bucket"]) & value.between(bucketed[lo], bucketed[hi])
    return probe.join(bucketed, cond, how).drop(probe["_bucket"]).drop(bucketed["_bucket"])
