"""Mixing sources to target weights by temperature.

A source's share p of all tokens gives its weight p**a / sum(p**a). The exponent
a (0 flattens, 1 keeps the shares) is searched by narrowing an interval around
the target, 32 points at a time, each round one aggregation over the table of
sources: a meets the target entropy (a fraction of the largest one, ln(sources)),
and is raised where that would repeat a source more than ``max_repeats`` times.

Weights times the token budget are the sources' quotas. A quota is realised as
whole epochs plus the head of one more permutation: rows are placed by a hash,
dealt into blocks of about ``block_docs`` rows, blocks are taken in order by
their token sums, and only the block in which the quota ends is cut inside.
A row's number of copies then needs its source's plan and its own hash only, so
no task gathers a source.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Defined results: null texts have no
tokens; a null source is a source; a source without tokens gets one epoch (it
costs nothing); rows that repeat id and text are drawn together; an empty table
gives an empty result; other columns pass unread, new names that clash get an
underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haze.llm.common import fresh, written

BLOCK_DOCS = 4096
_POINTS, _ROUNDS = 32, 5  # 32**-5 of the interval: 3e-8


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _curve(shares: DataFrame, points: list[float]) -> list[tuple[float, float]]:
    """(sum p**a, entropy of the weights) for each exponent a, in one aggregation."""
    row = shares.agg(*(F.sum(F.exp(F.lit(a) * F.col("lp"))) for a in points),
                     *(F.sum(F.exp(F.lit(a) * F.col("lp")) * F.lit(a) * F.col("lp")) for a in points)).first()
    return [(z, math.log(z) - s / z) for z, s in zip(row[:len(points)], row[len(points):])]


def _narrow(lo: float, hi: float, met) -> float:
    """Smallest exponent of [lo, hi] that ``met`` accepts (monotone); hi if none does."""
    for _ in range(_ROUNDS):
        points = [lo + (hi - lo) * k / _POINTS for k in range(_POINTS + 1)]
        ok = met(points)
        first = next((k for k, good in enumerate(ok) if good), _POINTS)
        if first == 0:
            return lo
        lo, hi = points[first - 1], points[first]
    return hi


def find_exponent(shares: DataFrame, entropy: float, max_repeats: float, budget_ratio: float | None) -> float:
    """shares: column lp, the log of each source's token share. budget_ratio:
    budget / all tokens, None for the least budget that gives every source an epoch."""
    low, high, n = shares.agg(F.min("lp"), F.max("lp"), F.count(F.lit(1))).first()
    if n <= 1 or low == high:
        return 1.0
    target = entropy * math.log(n)
    limit = 1.0
    while _curve(shares, [limit])[0][1] > target and limit < 64:
        limit *= 2
    a = _narrow(0.0, limit, lambda pts: [h <= target for _, h in _curve(shares, pts)])

    def within(pts):
        if budget_ratio is None:
            return [math.exp((x - 1) * (low - high)) <= max_repeats for x in pts]
        return [budget_ratio * max(math.exp((x - 1) * low), math.exp((x - 1) * high)) / z <= max_repeats
                for x, (z, _) in zip(pts, _curve(shares, pts))]
    return a if a >= 1 or within([a])[0] else _narrow(a, 1.0, within)


def mixing_plan(rows: DataFrame, entropy: float, max_repeats: float, budget: float | None,
                block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per source of ``rows`` (source, tokens, pos): weight, epochs, blocks,
    and where the last, partial epoch ends (last_block, last_pos)."""
    totals = written(rows.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("docs")), "mix-totals")
    whole = totals.agg(F.sum("total")).first()[0] or 0
    real = totals.filter("total > 0").withColumn("lp", F.log(F.col("total") / F.lit(float(whole or 1))))
    a = find_exponent(real, entropy, max_repeats, None if budget is None else budget / whole) if whole else 1.0
    z, high = real.agg(F.sum(F.exp(F.lit(a) * F.col("lp"))), F.max(F.col("lp") * (1 - a))).first()
    if budget is None:  # epochs are budget * weight / total = (budget / whole) p**(a-1) / z, at least one everywhere
        budget = whole * (z or 1.0) * math.exp(high or 0.0)
    weight = F.when(F.col("total") > 0, F.exp(F.lit(a) * F.log(F.col("total") / F.lit(float(whole or 1)))) / F.lit(z or 1.0)).otherwise(0.0)
    quota = F.col("weight") * F.lit(float(budget))
    repeats = F.when(F.col("total") > 0, quota / F.col("total") + F.lit(1e-9)).otherwise(1.0)
    plan = (totals.withColumn("weight", weight)
            .withColumn("epochs", F.floor(repeats))
            .withColumn("rest", F.greatest(F.when(F.col("total") > 0, quota - F.col("epochs") * F.col("total")).otherwise(0.0), F.lit(0.0)))
            .withColumn("blocks", F.ceil(F.col("docs") / F.lit(block_docs))))
    plan = written(plan, "mix-plan")
    placed = _placed(rows, plan)
    sums = placed.groupBy("source", "block").agg(F.sum("tokens").alias("sum"))
    order = Window.partitionBy("source").orderBy("block")
    ends = (sums.withColumn("end", F.sum("sum").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
            .filter(F.col("end") > F.col("rest")).groupBy("source")
            .agg(F.min(F.struct("block", (F.col("end") - F.col("sum")).alias("start"))).alias("cut"))
            .select(F.col("source").alias("cut_source"), F.col("cut.block").alias("last_block"), F.col("cut.start").alias("start")))
    ends = written(ends, "mix-ends")
    inside = placed.join(ends, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("block") == F.col("last_block")))
    within = Window.partitionBy("source").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)  # one block
    last = (inside.withColumn("cum", F.col("start") + F.sum("tokens").over(within))
            .filter(F.col("cum") <= F.col("rest")).groupBy(F.col("source").alias("pos_source")).agg(F.max("pos").alias("last_pos")))
    return written(
        plan.join(ends, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("pos_source")), "left")
        .select("source", "weight", "epochs", "blocks", "last_block", "last_pos"), "mix-cuts")


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.select(F.col("source").alias("plan_source"), "blocks", "rest")
    return (rows.join(p, F.col("source").eqNullSafe(F.col("plan_source")))
            .withColumn("block", F.shiftright(F.shiftright("pos", 31) * F.col("blocks"), 32)))


def position(seed: int, id_col: Column, text: Column) -> Column:
    """Place of a row in its source's permutation, 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text), 1)


def mix_sources(docs: DataFrame, entropy: float = 0.95, max_repeats: float = 4.0, budget: float | str | None = None,
                seed: int = 0, block_docs: int = BLOCK_DOCS, source_col: str = "source") -> DataFrame:
    """``docs`` with ``n_tokens``, ``weight`` (of its source) and ``copies``, for
    every row, also those drawn no times. budget: tokens of the mixture, "all" for
    the documents' own number, None for the least budget at which every source gets
    a whole epoch (then no document is lost)."""
    tok, pos, wgt, cop = (fresh(n, docs.columns) for n in ("n_tokens", "pos_", "weight", "copies"))
    full = docs.withColumn(tok, n_words(F.col("text"))).withColumn(pos, position(seed, F.col("doc_id"), F.col("text")))
    rows = written(full.select(F.col(source_col).cast("string").alias("source"), F.col(tok).alias("tokens"),
                               F.col(pos).alias("pos")), "mix-rows")
    if budget == "all":
        budget = float(rows.agg(F.sum("tokens")).first()[0] or 0) or None
    plan = mixing_plan(rows, entropy, max_repeats, budget, block_docs)
    names = {c: fresh(f"plan_{c}", full.columns) for c in plan.columns}
    plan = plan.select(*(F.col(c).alias(v) for c, v in names.items()))
    p = {c: F.col(v) for c, v in names.items()}
    block = F.shiftright(F.shiftright(F.col(pos), 31) * p["blocks"], 32)
    more = (block < p["last_block"]) | ((block == p["last_block"]) & (F.col(pos) <= p["last_pos"]))
    joined = full.join(plan, F.col(source_col).cast("string").eqNullSafe(p["source"]))
    return joined.select(*docs.columns, tok, p["weight"].alias(wgt),
                         (p["epochs"] + F.coalesce(more, F.lit(False)).cast("long")).alias(cop))
