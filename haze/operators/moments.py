"""Mergeable co-moments: correlations over all history from small daily states.

A state holds, for each pair of measures over the rows where both are present, the
row count, both means, both sums of squared deviations and the sum of their products
(centred, so merging loses no digits), and both ranges. States of any disjoint sets
of rows merge; a day's state replaces itself when its rows change, and the
correlation never reads the history again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The pairs of the weather correlation: (x, y) and the name of the result.
PAIRS = [("composite_aqi", "wind_speed_mps", "wind_aqi_correlation"),
         ("composite_aqi", "humidity_pct", "humidity_aqi_correlation"),
         ("composite_aqi", "temp_celsius", "temp_aqi_correlation"),
         ("composite_aqi", "rainfall_1h_mm", "rain_aqi_correlation")]


def _state(x: str, y: str) -> Column:
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    n = F.count(F.when(both, 1))
    return F.struct(n.alias("n"), F.avg(xs).alias("mx"), F.avg(ys).alias("my"), (F.var_pop(xs) * n).alias("sx"),
                    (F.var_pop(ys) * n).alias("sy"), (F.covar_pop(xs, ys) * n).alias("sxy"),
                    F.min(xs).alias("lx"), F.max(xs).alias("hx"), F.min(ys).alias("ly"), F.max(ys).alias("hy"))


def daily_states(rows: DataFrame, keys: list[str], pairs: list[tuple[str, str, str]] = PAIRS) -> DataFrame:
    """One state for each of ``keys``: the number of rows and one struct for each pair."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *(_state(x, y).alias(name) for x, y, name in pairs))


def correlations(states: DataFrame, key: str, pairs: list[tuple[str, str, str]] = PAIRS) -> DataFrame:
    """Per ``key``: the Pearson correlation of every pair and ``data_points_used``, from
    states alone. NULL for no pairs or where a side is constant.

    Each state is moved to the key's own mean before the sums, which keeps the digits
    that a difference of two large sums would lose.
    """
    over = Window.partitionBy(key)  # the key's days
    shifted, sums = {}, []
    for _, _, name in pairs:
        s = F.col(name)
        n = s["n"]
        total = F.sum(n).over(over)
        dx = s["mx"] - F.try_divide(F.sum(n * s["mx"]).over(over), total)
        dy = s["my"] - F.try_divide(F.sum(n * s["my"]).over(over), total)
        shifted[f"_{name}"] = F.struct((s["sx"] + n * dx * dx).alias("sx"), (s["sy"] + n * dy * dy).alias("sy"),
                                       (s["sxy"] + n * dx * dy).alias("sxy"))
        d = F.col(f"_{name}")
        varies = (F.max(s["hx"]) > F.min(s["lx"])) & (F.max(s["hy"]) > F.min(s["ly"]))
        sums.append(F.when(varies, F.try_divide(F.sum(d["sxy"]), F.sqrt(F.sum(d["sx"])) * F.sqrt(F.sum(d["sy"])))).alias(name))
    return states.withColumns(shifted).groupBy(key).agg(*sums, F.sum("rows").alias("data_points_used"))
