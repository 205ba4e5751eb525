"""ROWS-frame window functions over a partition key that may be heavily skewed.

``Window.partitionBy(key)`` sends every row of one key to one task, so one
city holding a third of the data would be sorted and scanned by one core.
``over_rows`` gives the same answers with bounded tasks:

1. Number the rows of each key in order (``_idx``) from counts: rows per (key,
   first order column), here city and hour, are counted and combined map-side;
   running sums over that small table give the rows before each hour, and a
   row's place inside its own hour completes its index. Rows are dealt by (key,
   hour), so a hot city is spread over as many tasks as it has hours.
2. Cut each key into blocks of ``block_rows`` consecutive rows. A frame reaches
   at most ``lookback`` rows back and ``lookahead`` rows ahead, so copying the
   last ``lookback`` rows of a block into the next block and the first
   ``lookahead`` rows into the previous one makes every frame complete inside
   one (key, block) partition.
3. Frames that start at UNBOUNDED PRECEDING (running max/min/sum) are computed
   inside the hour and combined with a carry: the aggregate of all earlier hours
   of the key, a further column of the table of step 1.

The numbering is a function of the rows alone (no sampled ranges, no partition
numbers), so a task that is run again after a lost executor numbers them as
before: nothing is persisted or checkpointed, and building a query starts no job.

Exact: the result equals the plain window for any data, provided the order
columns are unique within a key (which makes ROWS frames deterministic); ties
are ordered by the other columns, so that only equal rows are interchangeable.
The table of step 1 has a row per key and value of the first order column, and
its running sums take a key's values in one task: the column must be coarse (an
hour: under a million values a century), and one value of it must not hold more
rows of a key than a task can sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BLOCK_ROWS = 200_000
_AGGS = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
_CARRY = {"max": F.greatest, "min": F.least}


@dataclass(frozen=True)
class Frame:
    """``func(col) OVER (... ROWS BETWEEN lo AND hi)``; ``lo=None`` is UNBOUNDED
    PRECEDING. ``func="lag"`` with ``lo == hi == -n`` is ``lag(col, n)``."""
    func: str
    col: Column
    lo: int | None
    hi: int


def _plain(df: DataFrame, key: str, order: Sequence[str], specs: dict[str, Frame]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    cols = []
    for name, f in specs.items():
        if f.func == "lag":
            cols.append(F.lag(f.col, -f.lo).over(w).alias(name))
        else:
            lo = Window.unboundedPreceding if f.lo is None else f.lo
            cols.append(_AGGS[f.func](f.col).over(w.rowsBetween(lo, f.hi)).alias(name))
    return df.select("*", *cols)


def row_index(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Adds ``_idx``: 0-based position of each row within its key in ``order``."""
    return _numbered(df, key, order, {})


def _numbered(df: DataFrame, key: str, order: Sequence[str], running: dict[str, Frame]) -> DataFrame:
    """``df`` with ``_idx`` and one column per frame of ``running`` (unbounded
    preceding to the current row, or to the row before)."""
    # one column that is never null, so that window and join share one shuffle of the rows
    group = F.struct(F.col(key).alias("key"), F.col(order[0]).alias("first")).alias("_g")
    before = Window.partitionBy("_g.key").orderBy("_g.first").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select("*", group).groupBy("_g").agg(
        F.count(F.lit(1)).alias("_n"), *[_AGGS[f.func](f.col).alias(f"_c_{name}") for name, f in running.items()])
    offsets = counts.select(F.col("_g").alias("_og"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                            *[_AGGS[f.func](f"_c_{name}").over(before).alias(f"_c_{name}") for name, f in running.items()])
    rest = [c for c in df.columns if c != key and c not in order and isinstance(df.schema[c].dataType, T.AtomicType)]
    inside = Window.partitionBy("_g").orderBy(*([*order[1:], *rest] or order))
    own = df.select("*", group).select(
        "*", (F.row_number().over(inside) - 1).alias("_pos"),
        *[_AGGS[f.func](f.col).over(inside.rowsBetween(Window.unboundedPreceding, f.hi)).alias(f"_r_{name}")
          for name, f in running.items()])
    joined = own.join(offsets, F.col("_g") == F.col("_og"), "inner")
    return joined.select(*df.columns, (F.col("_offset") + F.col("_pos")).alias("_idx"), *[
        _merged(f, F.col(f"_r_{name}"), F.col(f"_c_{name}")).alias(name) for name, f in running.items()])


def _merged(f: Frame, own: Column, carry: Column) -> Column:
    if f.func == "sum":
        return F.when(own.isNull(), carry).when(carry.isNull(), own).otherwise(own + carry)
    return _CARRY[f.func](own, carry)


def spread_blocks(idx: DataFrame, block_rows: int, back: int, ahead: int) -> DataFrame:
    """Rows with ``_idx`` -> rows tagged with their block ``_blk`` (``_home``),
    plus copies of the last ``back`` rows of each block into the next block
    and of the first ``ahead`` rows into the previous one (``_home`` false)."""
    b = block_rows
    blk = F.call_function("div", F.col("_idx"), F.lit(b))
    off = F.col("_idx") % b
    copies = F.filter(F.array(
        F.struct(blk.alias("_blk"), F.lit(True).alias("_home")),
        F.when(off >= b - back, F.struct((blk + 1).alias("_blk"), F.lit(False).alias("_home"))),
        F.when((off < ahead) & (blk > 0), F.struct((blk - 1).alias("_blk"), F.lit(False).alias("_home"))),
    ), lambda x: x.isNotNull())
    return idx.select("*", F.inline(copies))


def over_rows(df: DataFrame, key: str, order: Sequence[str], specs: dict[str, Frame],
              block_rows: int | None = None) -> DataFrame:
    """``df`` plus one column per spec, as ``func OVER (PARTITION BY key ORDER
    BY order ROWS ...)``.

    Blocks have ``block_rows`` rows whatever the data's size; ``block_rows=0``
    asks for the plain window (the reference for tests).
    """
    if block_rows == 0:
        return _plain(df, key, order, specs)
    if block_rows is None:
        block_rows = DEFAULT_BLOCK_ROWS
    b = block_rows
    back = max([-f.lo for f in specs.values() if f.lo is not None and f.lo < 0] + [0])
    ahead = max([f.hi for f in specs.values() if f.hi > 0] + [0])
    if back >= b or ahead >= b:
        raise ValueError("block_rows must exceed the widest frame")
    for f in specs.values():
        if f.lo is None and f.func not in ("max", "min", "sum"):
            raise ValueError("unbounded frames support max, min and sum")

    running = {name: f for name, f in specs.items() if f.lo is None}
    if any(f.hi not in (0, -1) for f in running.values()):
        raise ValueError("unbounded frames must end at the current row or the row before")
    idx = _numbered(df, key, order, running)
    if len(running) < len(specs):
        w = Window.partitionBy(key, "_blk").orderBy("_idx")
        cols = []
        for name, f in specs.items():
            if f.func == "lag":
                cols.append(F.lag(f.col, -f.lo).over(w).alias(name))
            elif f.lo is not None:
                cols.append(_AGGS[f.func](f.col).over(w.rowsBetween(f.lo, f.hi)).alias(name))
        idx = spread_blocks(idx, b, back, ahead).select("*", *cols).where(F.col("_home"))
    return idx.select(*df.columns, *specs)


def global_rank(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """``RANK() OVER (ORDER BY value ASC NULLS FIRST)`` of a number without a
    single-task window over the rows.

    Rows per value are counted (combined map-side) and summed within strips of
    values (256 to a doubling, fixed: at most 600,000 over all doubles); only the
    strips' totals are summed in one task. The rank of a value is one plus the
    rows of smaller values, joined back on the value: ``df`` is read twice and must
    give the same values, as a stored table does (sums of doubles computed again may not).
    """
    v = F.col("_v").cast("double")
    # log1p is monotone, so strips are in the order of their values; null, infinities and NaN are strips at the ends
    strip = F.signum(v) * F.least(F.floor(F.least(F.log1p(F.abs(v)), F.lit(1e4)) * 256 / F.lit(0.6931471805599453)), F.lit(10**7))
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_strip", F.when(F.isnan(v), F.lit(2e7)).otherwise(strip))
    smaller = Window.partitionBy("_strip").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(F.lit(0)).orderBy(F.col("_s").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    strips = counts.groupBy(F.col("_strip").alias("_s")).agg(F.sum("_n").alias("_strip_n"))
    strips = strips.select("_s", F.coalesce(F.sum("_strip_n").over(below), F.lit(0)).alias("_below"))
    ranks = (counts.withColumn("_smaller", F.coalesce(F.sum("_n").over(smaller), F.lit(0)))
             .join(strips, F.col("_strip").eqNullSafe(F.col("_s")), "inner")
             .select("_v", (F.col("_below") + F.col("_smaller") + 1).alias(name)))
    return df.join(ranks, df[value].eqNullSafe(ranks["_v"]), "inner").drop("_v")
