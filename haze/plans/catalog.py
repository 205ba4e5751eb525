"""Registered queries: each runs one operator chain over the driver's tables.

Every query reads ``events`` (and ``nation``) under ``sf_dir`` and derives the
raw inputs from them (``haze.sources.fixtures``), so its work grows with the
tables. Outputs are normalized for comparison with the DuckDB oracle
(``haze.plans.oracle``): TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock),
INT -> BIGINT, DOUBLE rounded to 6 decimals (sums and averages depend on
the order of addition in the last bits).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haze import schemas, sinks
from haze.functions.exprs import epoch_to_timestamp
from haze.operators import backfill, enrich, marts, moments, quality, staging, validate
from haze.plans import hourly, incremental, pipeline
from haze.session import ensure_utc, scratch_path
from haze.snapshots import Warehouse
from haze.sources import fixtures, landing, seeds
from haze.streaming import ingest

ROUND_DIGITS = 6


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), ROUND_DIGITS)
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Models:
    """The model chain over one test folder, built lazily (plans only)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = ensure_utc(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def city_map(self) -> DataFrame:
        return fixtures.city_map(self.table("nation"))

    @cached_property
    def breakpoints(self) -> DataFrame:
        return fixtures.breakpoints(self.spark)

    @cached_property
    def raw_aqi(self) -> DataFrame:
        return fixtures.aqi_readings(self.events)

    @cached_property
    def raw_weather(self) -> DataFrame:
        return fixtures.weather_readings(self.events)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_readings(self.raw_aqi, self.city_map)

    @cached_property
    def wx(self) -> DataFrame:
        return staging.stg_weather(self.raw_weather, self.city_map)

    @cached_property
    def cat(self) -> DataFrame:
        return enrich.with_category(self.stg, self.breakpoints)

    @cached_property
    def joined(self) -> DataFrame:
        return enrich.join_weather(self.cat, self.wx)

    @cached_property
    def invalid(self) -> DataFrame:
        checked = validate.validate_readings(fixtures.aqi_payloads(self.events))
        return validate.quarantine_rows(checked, "aqi", F.col("landed_at"))


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Models], DataFrame]) -> Callable[[Models], DataFrame]:
        _REGISTRY[name] = lambda spark, sf_dir: finalize(fn(Models(spark, sf_dir)))
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


AS_OF = fixtures.AS_OF


@query("stg_readings_pivot")
def _q_stg(m: Models) -> DataFrame:
    return m.stg


@query("stg_weather_dedup")
def _q_wx(m: Models) -> DataFrame:
    return m.wx


@query("categorize_range_join")
def _q_cat(m: Models) -> DataFrame:
    return m.cat


@query("hour_join")
def _q_join(m: Models) -> DataFrame:
    return m.joined


@query("city_trends")
def _q_trends(m: Models) -> DataFrame:
    return marts.city_trends(m.joined)


@query("pollutant_breakdown")
def _q_poll(m: Models) -> DataFrame:
    return marts.pollutant_breakdown(m.cat)


@query("weather_correlation")
def _q_corr(m: Models) -> DataFrame:
    return marts.weather_correlation(m.joined)


@query("rain_impact")
def _q_rain(m: Models) -> DataFrame:
    return marts.rain_impact(m.joined)


@query("city_leaderboard")
def _q_rank(m: Models) -> DataFrame:
    return marts.city_leaderboard(marts.city_trends(m.joined))


@query("city_features")
def _q_feat(m: Models) -> DataFrame:
    return marts.city_features(m.joined)


@query("quality_metrics")
def _q_dq(m: Models) -> DataFrame:
    return quality.quality_metrics(m.stg, m.wx, m.invalid, AS_OF)


@query("pipeline_health")
def _q_health(m: Models) -> DataFrame:
    return quality.pipeline_health(m.stg, m.wx, AS_OF)


@query("epoch_detect")
def _q_epoch(m: Models) -> DataFrame:
    return m.raw_aqi.select("station_id", "reading_timestamp",
                            epoch_to_timestamp("reading_timestamp").alias("reading_ts"))


@query("dq_not_null")
def _q_not_null(m: Models) -> DataFrame:
    cat_nn = quality.run_checks("with_category", m.cat, {
        "not_null_reading_hour": quality.not_null("reading_hour"),
        "not_null_composite_aqi": quality.not_null("composite_aqi")})
    return (quality.staging_checks(m.stg).unionByName(quality.weather_checks(m.wx))
            .unionByName(cat_nn).unionByName(quality.joined_checks(m.joined)))


@query("dq_category_tests")
def _q_cat_tests(m: Models) -> DataFrame:
    return quality.category_checks(m.cat, AS_OF)


@query("dq_fresh")
def _q_fresh(m: Models) -> DataFrame:
    """Metrics runs at every hour that has events: the newest is fresh, of the runs
    before the stale date it is not."""
    runs = m.events.select(F.date_trunc("HOUR", F.col("ts").cast("timestamp")).alias("run_timestamp")).distinct()
    stale = runs.where(F.col("run_timestamp") < F.lit(fixtures.STALE_BEFORE).cast("timestamp"))
    return quality.metrics_fresh_check(runs, AS_OF).unionByName(
        quality.metrics_fresh_check(stale, AS_OF).withColumn("model", F.lit("stale_quality_metrics")))


@query("dq_source_freshness")
def _q_src_fresh(m: Models) -> DataFrame:
    aqi = m.raw_aqi.select(epoch_to_timestamp("fetched_at").alias("fetched_at"))
    return quality.source_freshness({
        "aqi_readings": (aqi, "fetched_at"),
        "weather_readings": (m.raw_weather, "fetched_at"),
    }, AS_OF)


@query("dq_coverage")
def _q_coverage(m: Models) -> DataFrame:
    return quality.coverage_metrics(m.cat)


@query("validate_readings")
def _q_validate(m: Models) -> DataFrame:
    checked = validate.validate_readings(fixtures.aqi_payloads(m.events))
    return validate.normalize_readings(
        checked, F.col("landed_at"), keep=("record_id", "error_field", "error_reason")
    ).drop("station_id", "pollutant_unit", "fetched_at")


@query("quarantine_counts")
def _q_quarantine_counts(m: Models) -> DataFrame:
    checked = validate.validate_readings(fixtures.aqi_payloads(m.events))
    return checked.groupBy("error_field", "error_reason").agg(F.count(F.lit(1)).alias("records"))


@query("pollutant_breakdown_ignore_nulls")
def _q_poll_ignore(m: Models) -> DataFrame:
    return marts.pollutant_breakdown(m.cat, ignore_nulls=True)


@query("rain_impact_all_context")
def _q_rain_all(m: Models) -> DataFrame:
    return marts.rain_impact(m.joined, context="all")


@query("city_features_by_hours")
def _q_feat_hours(m: Models) -> DataFrame:
    return marts.city_features(m.joined, by="hours")


@query("validate_weather")
def _q_validate_weather(m: Models) -> DataFrame:
    checked = validate.validate_weather(fixtures.weather_payloads(m.events))
    return validate.normalize_weather(checked, F.col("landed_at"),
                                      keep=("record_id", "error_field", "error_reason")).drop("fetched_at")


@query("hourly_array_explode")
def _q_hourly(m: Models) -> DataFrame:
    return landing.hourly_rows(fixtures.archive_payloads(m.events),
                               F.lit(fixtures.RUN_TS).cast("timestamp"), keep=("record_id",))


def _ledger(m: Models) -> DataFrame:
    """Days already done: the event days with an even day of month."""
    days = m.events.select(F.to_date(F.col("ts").cast("timestamp")).alias("day"))
    return days.where(F.dayofmonth("day") % 2 == 0).distinct()


@query("backfill_pending")
def _q_pending(m: Models) -> DataFrame:
    spine = backfill.day_spine(m.spark, fixtures.BACKFILL_START, fixtures.BACKFILL_END)
    return backfill.pending_days(spine, _ledger(m))


@query("backfill_days")
def _q_backfill_days(m: Models) -> DataFrame:
    """Two backfills of the same range over archived pages; the second finds no
    pending day with rows and changes nothing."""
    root = scratch_path(m.spark, "backfill")
    fixtures.land_aqi_pages(m.events, f"{root}/landing", archived=True)
    _ledger(m).write.parquet(f"{root}/ledger")
    for _ in range(2):
        backfill.backfill_readings(m.spark, f"{root}/landing", fixtures.BACKFILL_START, fixtures.BACKFILL_END,
                                   f"{root}/ledger", f"{root}/raw/aqi_readings",
                                   F.lit(fixtures.RUN_TS).cast("timestamp"), multiline=False)
    rows = sinks.read_table(m.spark, f"{root}/raw/aqi_readings", schemas.AQI_READINGS)
    return rows.select(F.col("station_id").cast("long").alias("record_id"),
                       F.to_date("reading_timestamp").alias("reading_date"), "station_name", "city",
                       "pollutant_avg", "reading_timestamp")


@query("json_landing")
def _q_json_landing(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "landing-aqi")
    fixtures.land_aqi_pages(m.events, path)
    records = landing.aqi_records(landing.read_aqi_pages(m.spark, path, multiline=False))
    checked = validate.validate_readings(records)
    return checked.select(F.col("id").cast("long").alias("record_id"), "error_field", "error_reason")


@query("stream_ingest")
def _q_stream_ingest(m: Models) -> DataFrame:
    root = scratch_path(m.spark, "stream-ingest")
    fixtures.land_aqi_pages(m.events, f"{root}/landing")
    q = ingest.start_ingest(m.spark, f"{root}/landing", f"{root}/aqi_readings",
                            f"{root}/invalid_records", f"{root}/_checkpoint",
                            multiline=False, max_files_per_trigger=2)
    q.awaitTermination()
    good = m.spark.read.parquet(f"{root}/aqi_readings").select(
        F.col("station_id").cast("long").alias("record_id"),
        F.lit(None).cast("string").alias("error_field"),
        F.lit(None).cast("string").alias("error_reason"))
    bad = m.spark.read.parquet(f"{root}/invalid_records").select(
        F.get_json_object("raw_payload", "$.id").cast("long").alias("record_id"),
        "error_field", "error_reason")
    return good.unionByName(bad)


@query("stream_pivot")
def _q_stream_pivot(m: Models) -> DataFrame:
    root = scratch_path(m.spark, "stream-pivot")
    raw = m.raw_aqi.select(
        "station_id", "station_name", "city", "state", "pollutant_id", "pollutant_avg",
        F.lit(None).cast("double").alias("pollutant_min"), F.lit(None).cast("double").alias("pollutant_max"),
        F.lit(None).cast("string").alias("pollutant_unit"),
        epoch_to_timestamp("reading_timestamp").alias("reading_timestamp"),
        epoch_to_timestamp("fetched_at").alias("fetched_at"))
    raw.repartition("station_name").write.parquet(f"{root}/aqi_readings")  # hours spread over all files
    q = ingest.start_hourly_pivot(m.spark, f"{root}/aqi_readings", m.city_map,
                                  f"{root}/stg", f"{root}/_checkpoint", max_files_per_trigger=4)
    q.awaitTermination()
    return sinks.read_table(m.spark, f"{root}/stg", m.stg.schema).select(m.stg.columns)


def _weather_backfill(m: Models, lists: list) -> DataFrame:
    """One backfill per city list (None: all cities), each twice, into one table."""
    root = scratch_path(m.spark, "backfill-weather")
    fixtures.archive_payloads(m.events).drop("record_id").write.json(f"{root}/archive")
    for cities in lists * 2:
        backfill.backfill_weather(m.spark, f"{root}/archive", "2024-01-10", "2024-01-20",
                                  f"{root}/weather_readings", F.lit(fixtures.RUN_TS).cast("timestamp"),
                                  cities=cities, multiline=False)
    rows = sinks.read_table(m.spark, f"{root}/weather_readings", schemas.WEATHER_READINGS)
    return rows.select(*schemas.WEATHER_READINGS.fieldNames(), F.to_date("recorded_at").alias("recorded_date"))


@query("backfill_weather_range")
def _q_backfill_weather(m: Models) -> DataFrame:
    return _weather_backfill(m, [m.city_map.select(F.col("raw_city_name").alias("city"))])


@query("backfill_weather_two_lists")
def _q_backfill_weather_lists(m: Models) -> DataFrame:
    """The second list must not erase the first one's rows of the same dates."""
    cities = m.city_map.select(F.col("raw_city_name").alias("city"))
    return _weather_backfill(m, [cities.where(F.col("city") < "N2"), cities.where(F.col("city") >= "N2")])


@query("run_raw_readings")
def _q_run_raw(m: Models) -> DataFrame:
    """Raw rows of a run that is tried twice and of a later run over the same landing."""
    root = scratch_path(m.spark, "run-raw")
    fixtures.land_aqi_pages(m.events, f"{root}/landing")
    stamp = F.lit(fixtures.RUN_TS).cast("timestamp")
    for load in ("run-1", "run-1", "run-2"):
        pipeline.ingest_readings(m.spark, f"{root}/landing", f"{root}/wh", stamp, load, multiline=False)
    return pipeline.read_raw(m.spark, f"{root}/wh", "aqi_readings")


def _weather_runs(m: Models) -> str:
    root = scratch_path(m.spark, "run-weather")
    fixtures.land_weather_objects(m.events, f"{root}/landing")
    stamp = F.lit(fixtures.RUN_TS).cast("timestamp")
    for load in ("run-1", "run-1", "run-2"):
        pipeline.ingest_weather(m.spark, f"{root}/landing", f"{root}/wh", stamp, load, multiline=False)
    return f"{root}/wh"


@query("run_raw_weather")
def _q_run_raw_weather(m: Models) -> DataFrame:
    return pipeline.read_raw(m.spark, _weather_runs(m), "weather_readings")


@query("run_quarantine")
def _q_run_quarantine(m: Models) -> DataFrame:
    """Quarantined records of repeated runs by source, field and reason."""
    warehouse = _weather_runs(m)
    landed = scratch_path(m.spark, "run-quarantine")
    fixtures.land_aqi_pages(m.events, landed)
    for load in ("run-1", "run-1", "run-2"):
        pipeline.ingest_readings(m.spark, landed, warehouse, F.lit(fixtures.RUN_TS).cast("timestamp"), load, multiline=False)
    return (pipeline.read_raw(m.spark, warehouse, "invalid_records")
            .groupBy("source", "error_field", "error_reason").agg(F.count(F.lit(1)).alias("records")))


@query("seed_city_map")
def _q_seed_city_map(m: Models) -> DataFrame:
    """City aliases written as a seed CSV and loaded from it."""
    path = scratch_path(m.spark, "seed-city-map")
    m.city_map.write.option("header", True).csv(path)
    return seeds.read_city_map(m.spark, path)


@query("hourly_run")
def _q_pipeline(m: Models) -> DataFrame:
    """The whole run over payloads landed from the events; returns the test report."""
    root = scratch_path(m.spark, "pipeline")
    fixtures.land_aqi_pages(m.events, f"{root}/landing/aqi")
    fixtures.land_weather_objects(m.events, f"{root}/landing/weather")
    pipeline.run(m.spark, f"{root}/landing/aqi", f"{root}/landing/weather", f"{root}/wh",
                 run_ts=fixtures.RUN_TS, as_of=AS_OF, city_map=m.city_map, multiline=False)
    return m.spark.read.parquet(f"{root}/wh/quality/tests").drop("load_id")


@query("sink_roundtrip")
def _q_sink(m: Models) -> DataFrame:
    path = scratch_path(m.spark, "mart-city-trends")
    trends = marts.city_trends(m.joined)
    sinks.write_table(trends, path, "overwrite", partition_by=["reading_date"],
                      cluster_by=["canonical_city"])
    return m.spark.read.parquet(path)


@query("quarantine_envelope")
def _q_quarantine(m: Models) -> DataFrame:
    return m.invalid


@query("weather_quarantine")
def _q_weather_quarantine(m: Models) -> DataFrame:
    checked = validate.validate_weather(fixtures.weather_payloads(m.events))
    return validate.quarantine_rows(checked, "weather", F.col("landed_at"),
                                    payload=validate.weather_quarantine_payload())


# The skew-proof block evaluation of the ROWS windows, forced with small blocks
# so that every city spans many blocks; results must equal the plain windows.
SMALL_BLOCK_ROWS = 64


@query("city_features_blocked")
def _q_feat_blocked(m: Models) -> DataFrame:
    return marts.city_features(m.joined, block_rows=SMALL_BLOCK_ROWS)


@query("rain_impact_blocked")
def _q_rain_blocked(m: Models) -> DataFrame:
    return marts.rain_impact(m.joined, block_rows=SMALL_BLOCK_ROWS)


@query("dq_accepted")
def _q_dq_accepted(m: Models) -> DataFrame:
    """Accepted category labels (a NULL category passes)."""
    return quality.run_checks("with_category", m.cat, {
        "valid_aqi_category": quality.accepted_values("aqi_category", schemas.CATEGORIES)})


@query("dq_future")
def _q_dq_future(m: Models) -> DataFrame:
    """No reading hour beyond as_of + 6 h."""
    return quality.category_checks(m.cat, AS_OF).where(F.col("test_name") == "no_future_timestamps")


@query("dq_positive")
def _q_dq_positive(m: Models) -> DataFrame:
    return quality.category_checks(m.cat, AS_OF).where(F.col("test_name") == "aqi_positive")


# ---------------------------------------------------------------- incremental runs

def _land_in_parts(m: Models) -> Warehouse:
    """Three loads: most rows up to a date; the later dates and one earlier load again;
    late rows of two days."""
    warehouse = Warehouse(m.spark, scratch_path(m.spark, "incremental"))
    ts = F.col("ts").cast("timestamp")
    late = F.dayofmonth(ts).isin(5, 18) & (F.col("event_id") % 5 == 0)
    first = m.events.where(~late & (F.dayofmonth(ts) <= 20))
    parts = [("load-1", first.where("event_id % 2 = 0")), ("load-1", first), ("load-2", m.events.where(~late & (F.dayofmonth(ts) > 20))),
             ("load-3", m.events.where(late))]
    for load, part in parts:
        incremental.refresh(warehouse, load, fixtures.aqi_readings(part), fixtures.weather_readings(part), m.city_map, m.breakpoints)
    return warehouse


def melted(mart: str, df: DataFrame, at: str | None) -> DataFrame:
    """(mart, canonical_city, at_time, measure, value, label): one row for each measure of a row."""
    keys = ["canonical_city"] + ([at] if at else [])
    measures = []
    for f in df.schema.fields:
        if f.name not in keys:
            text = isinstance(f.dataType, T.StringType)
            measures.append(F.struct(F.lit(f.name).alias("measure"), (F.lit(None) if text else F.col(f.name)).cast("double").alias("value"),
                                     (F.col(f.name) if text else F.lit(None)).cast("string").alias("label")))
    when = (F.col(at) if at else F.lit(None)).cast("timestamp").alias("at_time")
    return df.select(F.lit(mart).alias("mart"), "canonical_city", when, F.inline(F.array(*measures)))


MART_TIMES = {"city_aqi_trends": "reading_date", "pollutant_breakdown": "reading_date", "weather_aqi_correlation": None,
              "rain_impact": "rain_event_date", "worst_best_cities": None, "features_city_air_quality": "reading_hour"}


@query("incremental_run")
def _q_incremental(m: Models) -> DataFrame:
    """Every mart after four incremental refreshes; equals a full refresh of all rows."""
    warehouse = _land_in_parts(m)
    snapshot = warehouse.snapshot()
    out = [melted(mart, warehouse.read(mart, snapshot=snapshot), at) for mart, at in MART_TIMES.items()]
    for df in out[1:]:
        out[0] = out[0].unionByName(df)
    return out[0]


class _Killed(Exception):
    pass


@query("run_snapshot")
def _q_run_snapshot(m: Models) -> DataFrame:
    """Rows of each table while a second load is killed again and again (after a write of
    its raw rows, of a model, and before the commit), and once it has ended."""
    warehouse = Warehouse(m.spark, scratch_path(m.spark, "run-snapshot"))
    early = F.dayofmonth(F.col("ts").cast("timestamp")) <= 20

    def load(name: str, part: DataFrame, dies_at: str | None = None) -> None:
        def hook(step: str) -> None:
            if step == dies_at:
                raise _Killed(step)
        incremental.refresh(warehouse, name, fixtures.aqi_readings(part), fixtures.weather_readings(part), m.city_map, m.breakpoints, hook=hook)

    def counted(state: str) -> DataFrame:
        snapshot = warehouse.snapshot()
        out = [warehouse.read(t, snapshot=snapshot).agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(state).alias("state"), F.lit(t).alias("table_name"), "table_rows") for t in SNAPSHOT_TABLES]
        for df in out[1:]:
            out[0] = out[0].unionByName(df)
        return out[0]
    load("load-1", m.events.where(early))
    for step in ("raw_weather", "joined", "commit"):
        try:
            load("load-2", m.events.where(~early), dies_at=step)
        except _Killed:
            continue
    killed = counted("killed")
    load("load-2", m.events.where(~early))
    return killed.unionByName(counted("done"))


SNAPSHOT_TABLES = ["raw_readings", "stg_readings", "stg_weather", "joined", "city_aqi_trends", "rain_impact", "features_city_air_quality"]


# ---------------------------------------------------------------- hourly runs over a warehouse

@query("hourly_warehouse")
def _q_hourly_warehouse(m: Models) -> DataFrame:
    """The test report after two runs over a growing landing, as one full run gives it."""
    root = scratch_path(m.spark, "hourly")
    warehouse = Warehouse(m.spark, f"{root}/wh")
    for run, run_ts in enumerate(("2024-01-30 20:00:00", AS_OF)):
        part = m.events.where(F.col("event_id") % 2 == run)
        fixtures.land_aqi_pages(part, f"{root}/landing/aqi/hour={run}")
        fixtures.land_weather_objects(part, f"{root}/landing/weather/hour={run}")
        hourly.run(warehouse, f"{root}/landing/aqi", f"{root}/landing/weather", run_ts, m.city_map, m.breakpoints, multiline=False)
    return warehouse.read("test_report").where(F.col("run_timestamp") == F.lit(AS_OF).cast("timestamp"))


@query("hourly_quarantine")
def _q_hourly_quarantine(m: Models) -> DataFrame:
    """Weather landed by requested city and taken three times (tried again, and once more with
    nothing new): its quarantine names the requested city, also where the payload has no name."""
    root = scratch_path(m.spark, "hourly-quarantine")
    fixtures.land_requested_weather(m.events, f"{root}/landing")
    warehouse = Warehouse(m.spark, f"{root}/wh")
    for load in ("run-1", "run-1", "run-2"):
        tx = warehouse.begin()
        hourly.ingest(tx, incremental.Changes(), m.city_map, {"weather": f"{root}/landing"}, F.lit(AS_OF).cast("timestamp"), load,
                      multiline=False, requests=fixtures.request_manifest(m.spark, f"{root}/landing"))
        tx.commit()
    return warehouse.read("invalid_records").select("source", "error_reason", "error_field", "raw_payload")


@query("backfill_weather_warehouse")
def _q_backfill_warehouse(m: Models) -> DataFrame:
    """Two city lists, each twice, into a raw table by date; two dates are read."""
    root = scratch_path(m.spark, "backfill-warehouse")
    fixtures.archive_payloads(m.events).drop("record_id").write.json(f"{root}/archive")
    cities = m.city_map.select(F.col("raw_city_name").alias("city"))
    warehouse = Warehouse(m.spark, f"{root}/wh")
    for some in [cities.where("city < 'N2'"), cities.where("city >= 'N2'")] * 2:
        backfill.backfill_weather_dates(warehouse, f"{root}/archive", "2024-01-10", "2024-01-20",
                                        F.lit(fixtures.RUN_TS).cast("timestamp"), cities=some, multiline=False)
    rows = warehouse.read("raw_weather", ["2024-01-12", "2024-01-19"])
    return rows.select(*schemas.WEATHER_READINGS.fieldNames(), F.to_date("recorded_at").alias("recorded_date"))


@query("quality_metrics_stats")
def _q_metrics_stats(m: Models) -> DataFrame:
    return quality.metrics_from_stats(quality.readings_stats(m.stg), quality.weather_stats(m.wx), quality.invalid_stats(m.invalid), AS_OF)


@query("pipeline_health_stats")
def _q_health_stats(m: Models) -> DataFrame:
    return quality.health_from_stats(quality.readings_stats(m.stg), quality.weather_stats(m.wx), AS_OF)


@query("weather_correlation_states")
def _q_corr_states(m: Models) -> DataFrame:
    states = moments.daily_states(m.joined.where("has_weather_data"), ["canonical_city", "reading_date"])
    return moments.correlations(states, "canonical_city")
