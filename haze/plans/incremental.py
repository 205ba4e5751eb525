"""Incremental refresh: new raw rows -> the output partitions they can change.

Every table lives in a ``snapshots.Warehouse`` by date. A refresh stores the new raw
rows, and then, in one transaction:

* rebuilds the staging, weather, joined, daily trend and pollutant tables, the city
  days, the daily co-moments and the statistics of the data-quality tables for the
  dates that got or lost rows, reading those dates alone;
* finds the (city, date) pairs whose rain impact or features change. Their frames are
  counted in rows (3 to 23 back, 3 to 6 ahead), so how many dates they reach depends
  on the data: ``city_days`` has the rows of each city and date, and a running
  count tells which dates lie within reach of a changed one. The unbounded "last
  rain" is the newest rain hour of the earlier days, also from ``city_days``: dates
  where it changes are recomputed, all others restart from it;
* recomputes those pairs from the dates that their frames reach, and keeps the other
  rows of the dates it replaces;
* rebuilds the correlation from the daily co-moments and the leaderboard from the
  daily trends, both a row for each city and day, never from readings;
* publishes everything with one rename.

The result equals a full refresh over all raw rows, whatever the cut into loads, late
rows and repeated loads included. New aliases or breakpoints change every date.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haze import sinks
from haze.functions.exprs import to_instant
from haze.functions.joins import maybe_broadcast
from haze.operators import enrich, marts, moments, quality, staging
from haze.plans.pipeline import _concurrently
from haze.session import ensure_utc
from haze.snapshots import NO_DATE, Snapshot, Transaction, Warehouse

CITY, DATE = "canonical_city", "reading_date"
PAIR = [CITY, DATE]
# Rows that the frames of each mart reach back and ahead, and the count they run over.
FEATURES = ("rows", 23, 3)
RAIN = ("rainy_rows", 3, 6)

MARTS = ["city_aqi_trends", "pollutant_breakdown", "weather_aqi_correlation", "rain_impact", "worst_best_cities",
         "features_city_air_quality"]


def city_days(joined: DataFrame) -> DataFrame:
    """Per city and date: rows with weather, rainy ones among them, newest rain hour."""
    rain = F.when(F.col("rainfall_1h_mm") > 0, F.col("reading_hour"))
    return joined.where("has_weather_data").groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_raining").alias("rainy_rows"), F.max(rain).alias("last_rain"))


def within_reach(days: DataFrame, flag: str, count: str, before: int, after: int, name: str) -> DataFrame:
    """Adds ``name``: the date is flagged, or has a row among the ``before`` rows ahead of a
    flagged date or the ``after`` rows behind one, of the same city."""
    order = Window.partitionBy(CITY).orderBy(DATE)
    past, coming = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    n = F.coalesce(F.col(count), F.lit(0))
    days = days.withColumn("_end", F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - n)
    days = days.withColumn("_left", F.max(F.when(F.col(flag), F.col("_end"))).over(past)).withColumn(
        "_right", F.min(F.when(F.col(flag), F.col("_start"))).over(coming))
    near = F.col(flag) | (F.col("_start") - F.col("_left") < after) | (F.col("_right") - F.col("_end") < before)
    return days.withColumn(name, F.coalesce(near, F.col(flag))).drop("_end", "_start", "_left", "_right")


def _on(df: DataFrame, pairs: DataFrame, date: Column, how: str) -> DataFrame:
    """Rows of ``df`` whose (city, date) is among ``pairs`` (semi) or is not (anti)."""
    p = maybe_broadcast(pairs.select(F.col(CITY).alias("_c"), F.col(DATE).alias("_d")))
    return df.join(p, df[CITY].eqNullSafe(F.col("_c")) & (date == F.col("_d")), how)


def changed_days(before: DataFrame, after: DataFrame, pairs: DataFrame) -> DataFrame:
    """City days old and new side by side, with ``touched`` (the pair got or lost rows) and
    the newest rain of earlier days (``carry_rain``), whose change counts as touched by rain."""
    old = before.select(F.col(CITY).alias("_c"), F.col(DATE).alias("_d"), F.col("last_rain").alias("_old_rain"))
    both = after.join(old, after[CITY].eqNullSafe(old["_c"]) & (after[DATE] == old["_d"]), "full_outer").select(
        F.coalesce(CITY, "_c").alias(CITY), F.coalesce(DATE, "_d").alias(DATE), "rows", "rainy_rows", "last_rain", "_old_rain")
    marked = pairs.select(F.col(CITY).alias("_c"), F.col(DATE).alias("_d"), F.lit(True).alias("_t")).distinct()
    both = both.join(marked, both[CITY].eqNullSafe(marked["_c"]) & (both[DATE] == marked["_d"]), "left")
    earlier = Window.partitionBy(CITY).orderBy(DATE).rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("carry_rain", F.max("last_rain").over(earlier)).withColumn("_old_carry", F.max("_old_rain").over(earlier))
    return both.select(*PAIR, "rows", "rainy_rows", "carry_rain", F.col("_t").isNotNull().alias("touched"),
                       (~F.col("carry_rain").eqNullSafe(F.col("_old_carry"))).alias("carry_changed"))


def _dates(df: DataFrame) -> set[str]:
    """Distinct dates, bounded by the calendar."""
    return {r[0] for r in df.select(F.col(DATE).cast("string")).distinct().collect() if r[0] is not None}


def _reseeded(seeds: list[DataFrame]) -> str:
    """Changes when a seed table does."""
    return "/".join(str(s.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(s.columns)))).cast("decimal(38,0)"))).first()) for s in seeds)


def _frame_mart(tx: Transaction, table: str, days: DataFrame, reach: tuple[str, int, int], date: Column, columns: Callable[[DataFrame], DataFrame]) -> None:
    """Replaces the rows of one mart with row frames for the pairs that change."""
    count, back, ahead = reach
    flags = within_reach(days, "flag", count, ahead, back, "changes")
    flags = within_reach(flags, "changes", count, back, ahead, "needed").where("needed")
    flags = sinks.pinned(flags.select(*PAIR, "changes", "carry_rain"), "incremental-reach")
    changes = flags.where("changes")
    dates = _dates(changes)
    if not dates:
        if table not in tx.tables:
            tx.replace(table, columns(_with_carry(tx.read("joined", []), flags)), date, set())
        return
    rows = _with_carry(tx.read("joined", _dates(flags)), flags)
    made = _on(columns(rows), changes, date, "left_semi")
    if table in tx.tables:
        made = made.unionByName(_on(tx.read_before(table, dates), changes, date, "left_anti"))
    tx.replace(table, made, date, dates)


def _with_carry(joined: DataFrame, flags: DataFrame) -> DataFrame:
    f = maybe_broadcast(flags.select(F.col(CITY).alias("_c"), F.col(DATE).alias("_d"), "carry_rain"))
    return joined.join(f, joined[CITY].eqNullSafe(F.col("_c")) & (joined[DATE] == F.col("_d")), "inner").drop("_c", "_d")


SOURCES = {"raw_readings": "reading_timestamp", "raw_weather": "recorded_at"}


@dataclass
class Changes:
    """What a load changed: the dates of each raw table, and (city, date) pairs with rows that came or went."""
    dates: dict[str, set[str]] = field(default_factory=lambda: {t: set() for t in SOURCES})
    pairs: list[DataFrame] = field(default_factory=list)

    def add(self, table: str, dates: set[str], rows: DataFrame, city_map: DataFrame) -> None:
        self.dates[table] |= dates
        day = F.to_date(SOURCES[table]).alias(DATE)
        self.pairs.append(staging.canonicalize_city(rows, city_map).select(CITY, day).where(F.col(DATE).isNotNull()))


def refresh(warehouse: Warehouse, load: str, readings: DataFrame | None, weather: DataFrame | None,
            city_map: DataFrame, breakpoints: DataFrame, workers: int = 4,
            hook: Callable[[str], None] | None = None) -> Snapshot:
    """Stores the raw rows of ``load`` and publishes all tables as of now. ``hook`` is called
    after each write (tests)."""
    ensure_utc(warehouse.spark)
    tx = warehouse.begin()
    tx.hook = hook or tx.hook
    changes = Changes()
    for table, rows in (("raw_readings", readings), ("raw_weather", weather)):
        if rows is not None:
            stamp = SOURCES[table]
            rows = rows.withColumns({c: to_instant(c, rows.schema[c].dataType) for c in (stamp, "fetched_at")})
            changes.add(table, *tx.load(table, rows, F.to_date(stamp), load), city_map)
    return tx.commit(rebuild(tx, changes, city_map, breakpoints, workers))


def rebuild(tx: Transaction, changes: Changes, city_map: DataFrame, breakpoints: DataFrame, workers: int = 4) -> dict[str, str]:
    """Brings every table of the transaction up to its raw rows; returns the commit's notes."""
    for table in SOURCES:
        if table not in tx.tables:
            raise ValueError(f"the first load needs rows of both kinds: {table} has none")
    touched, pairs = changes.dates, changes.pairs
    notes = {"seeds": _reseeded([city_map, breakpoints])}
    if "seeds" in tx.base.notes and tx.base.notes["seeds"] != notes["seeds"]:
        touched = {t: tx.parts(t) for t in SOURCES}
        every = Changes()
        for t in SOURCES:
            every.add(t, touched[t], tx.read(t), city_map)
        pairs = [*every.pairs, tx.read_before("city_days").select(*PAIR)]  # the last: names that went out of use
    touched = {t: dates - {NO_DATE} for t, dates in touched.items()}
    day = F.col(DATE)

    stg = staging.stg_readings(tx.read("raw_readings", touched["raw_readings"]), city_map)
    wx = staging.stg_weather(tx.read("raw_weather", touched["raw_weather"]), city_map)
    _concurrently({
        "stg": lambda: tx.replace("stg_readings", stg, day, touched["raw_readings"]),
        "wx": lambda: tx.replace("stg_weather", wx, F.to_date("weather_hour"), touched["raw_weather"]),
    }, workers)
    dates = touched["raw_readings"] | touched["raw_weather"]
    stored = tx.read("stg_readings", dates)
    cat = enrich.with_category(stored, breakpoints)
    tx.replace("joined", enrich.join_weather(cat, tx.read("stg_weather", dates)), day, dates)

    joined = tx.read("joined", dates)
    checked = quality.daily_checks(stored, tx.read("stg_weather", dates), cat, joined)
    hours = {"readings_stats": (quality.readings_stats(stored), dates),
             "weather_stats": (quality.weather_stats(tx.read("stg_weather", touched["raw_weather"])), touched["raw_weather"])}
    _concurrently({
        "trends": lambda: tx.replace("city_aqi_trends", marts.city_trends(joined), day, dates),
        "breakdown": lambda: tx.replace("pollutant_breakdown", marts.pollutant_breakdown(cat), day, dates),
        "days": lambda: tx.replace("city_days", city_days(joined), day, dates),
        "moments": lambda: tx.replace("city_day_moments", moments.daily_states(joined.where("has_weather_data"), PAIR), day, dates),
        "checks": lambda: tx.replace("daily_checks", checked, F.col("day"), dates, cluster_by=()),
        **{t: (lambda t=t, df=df, part=part: tx.replace(t, df, F.to_date("hour"), part, cluster_by=())) for t, (df, part) in hours.items()},
    }, workers)

    all_pairs = pairs[0]
    for p in pairs[1:]:
        all_pairs = all_pairs.unionByName(p)
    after = tx.read("city_days")
    days = sinks.pinned(changed_days(tx.read_before("city_days", schema=after.schema), after, all_pairs), "incremental-days")
    _concurrently({
        "features": lambda: _frame_mart(tx, "features_city_air_quality", days.withColumn("flag", F.col("touched") | F.col("carry_changed")),
                                        FEATURES, F.to_date("reading_hour"), marts.city_features),
        "rain": lambda: _frame_mart(tx, "rain_impact", days.withColumn("flag", F.col("touched")), RAIN, F.col("rain_event_date"), marts.rain_impact),
        "correlation": lambda: tx.replace("weather_aqi_correlation", moments.correlations(tx.read("city_day_moments"), CITY)),
        "leaderboard": lambda: tx.replace("worst_best_cities", marts.city_leaderboard(tx.read("city_aqi_trends"))),
    }, workers)
    return notes
