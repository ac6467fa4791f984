"""Every registered query: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or data Spark derives from them) in
full.  Money stays DECIMAL inside plans; results present it as double.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripline.model import ORDERS_MODEL
from tripline.operators import anomaly, clean, enrich, partials, quality, report
from tripline.plans import adhoc, etl, layout, loads, published, views
from tripline.plans.pipeline import Pipeline
from tripline.session import scratch_path
from tripline.sources import drift, files, tables

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the layout query (one zone, one quarter).
LAYOUT_ZONE = 7
LAYOUT_START = "1997-07-01"
LAYOUT_END = "1997-09-30"

# Fixed parameter of the queries that load months in two steps.
LOAD_SPLIT = "1997-01-01"

GUARDED_SQL = (
    "SELECT day, trips, revenue FROM vw_daily_kpis "
    "WHERE revenue > (SELECT AVG(revenue) FROM vw_daily_kpis) "
    "ORDER BY revenue DESC, day"
)

_REGISTRY: dict[str, QueryFn] = {}


def present(df: DataFrame) -> DataFrame:
    """Cast DECIMAL result columns to double."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        wrapped.__name__ = name
        wrapped.__doc__ = fn.__doc__
        _REGISTRY[name] = wrapped
        return wrapped

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def _checks_of(spark, sf_dir, *families: str) -> DataFrame:
    """One check family, with the counts that it needs only."""
    return Pipeline(spark, sf_dir).checks_of(families)


# --- sources ---------------------------------------------------------------------


def _drift_source(sf_dir: str) -> tuple:
    paths = [tables.table_path(sf_dir, t) for t in tables.DRIFT_TABLES]
    return paths, tables.DRIFT_CANONICAL, tables.DRIFT_ALIASES


@query("src_align_union")
def src_align_union(spark, sf_dir):
    """Two files with drifting schemas, grouped by footer schema, cast to the
    canonical schema and unioned by name."""
    return drift.read_aligned(spark, *_drift_source(sf_dir))


@query("src_schema_drift")
def src_schema_drift(spark, sf_dir):
    return drift.drift_frame(spark, *_drift_source(sf_dir))


@query("src_partition_roundtrip")
def src_partition_roundtrip(spark, sf_dir):
    """Cleaned trips written month-partitioned, read back with partition
    discovery, rows per partition."""
    path = scratch_path(spark, "trips_cleaned")
    files.write_partitioned(Pipeline(spark, sf_dir).trips, path, "year_month")
    back = files.read_partitioned(spark, path, "year_month")
    return back.groupBy("year_month").agg(F.count(F.lit(1)).alias("rows"))


@query("ingest_manifest")
def ingest_manifest(spark, sf_dir):
    manifest = Pipeline(spark, sf_dir).manifest
    return manifest.select("file_name", "rows", "in_bounds", "warning", (F.col("bytes") > 0).alias("has_bytes"))


@query("ingest_manifest_bytes")
def ingest_manifest_bytes(spark, sf_dir):
    """Bytes of every source file; a database over views does not know them."""
    return Pipeline(spark, sf_dir).manifest.select("file_name", "bytes", "rows")


# --- cleaning --------------------------------------------------------------------


@query("clean_trips")
def clean_trips(spark, sf_dir):
    return Pipeline(spark, sf_dir).cleaned


@query("clean_trips_year")
def clean_trips_year(spark, sf_dir):
    """Cleaning with the year rule: one year of start dates."""
    return Pipeline(spark, sf_dir, replace(ORDERS_MODEL, year=1997)).cleaned


@query("clean_reject_profile")
def clean_reject_profile(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    return clean.reject_profile(p.raw, p.model)


@query("dedupe_exact")
def dedupe_exact(spark, sf_dir):
    """Cleaning over trips with exact copies appended, then whole-row dedupe."""
    return Pipeline(spark, sf_dir, with_copies=True).deduped


@query("etl_step_counts")
def etl_step_counts(spark, sf_dir):
    return Pipeline(spark, sf_dir, with_copies=True).step_counts.select(
        "raw_rows_read", "invalid_rows_dropped", "duplicate_rows_dropped",
        "final_cleaned_rows", "daily_zone_agg_rows", "hourly_profile_rows",
    )


@query("src_zone_csv")
def src_zone_csv(spark, sf_dir):
    """The zone dimension written as a lookup CSV and read back."""
    path = scratch_path(spark, "zones_csv")
    Pipeline(spark, sf_dir).zones.select(
        F.col("zone_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"),
        F.lit("zone").alias("service_zone"),
    ).write.mode("overwrite").option("header", True).csv(path)
    return files.read_zone_csv(spark, path)


def _etl(spark, sf_dir) -> tuple[Pipeline, str]:
    """The ETL job on the driver tables: its tables and manifest in a folder."""
    p, out = Pipeline(spark, sf_dir), scratch_path(spark, "etl")
    etl.run_etl(spark, p.raw, p.zones, p.model, out, p.drift)
    return p, out


@query("etl_written_daily")
def etl_written_daily(spark, sf_dir):
    """The daily aggregate that the ETL job wrote."""
    return spark.read.parquet(f"{_etl(spark, sf_dir)[1]}/daily_zone_agg")


@query("etl_manifest_steps")
def etl_manifest_steps(spark, sf_dir):
    """Step counts of the ETL job, read from its manifest document."""
    path = f"{_etl(spark, sf_dir)[1]}/etl_manifest"
    return files.read_json_report(spark, path, etl.MANIFEST_SCHEMA, required=True).select("steps.*")


@query("etl_report")
def etl_report(spark, sf_dir):
    """Checks over the written tables, read from the validation report."""
    p, out = _etl(spark, sf_dir)
    etl.run_validation(spark, out, p.model, p.ingest_rows, f"{out}/validation", gate=False)
    return etl.load_checks(spark, f"{out}/validation")


@query("etl_written_flags")
def etl_written_flags(spark, sf_dir):
    """Anomaly flags that the anomaly job wrote from the ETL's aggregate."""
    return etl.run_anomaly(spark, _etl(spark, sf_dir)[1])


# --- enrichment ------------------------------------------------------------------


@query("enrich_zones")
def enrich_zones(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    return enrich.attach_zones(p.deduped, p.zones, p.model)


@query("derive_trip_metrics")
def derive_trip_metrics(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    m = p.model
    return enrich.derive_metrics(p.deduped, m).select(
        *m.natural_key, m.start, m.end, m.distance, m.total,
        "trip_duration_min", "avg_speed_mph", "revenue_per_mile",
    )


@query("derive_calendar")
def derive_calendar(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    m = p.model
    return enrich.derive_calendar(p.deduped, m).select(
        *m.natural_key, m.start, "pickup_date", "pickup_hour", "pickup_dow", "year_month"
    )


@query("derive_event_calendar")
def derive_event_calendar(spark, sf_dir):
    """Calendar columns of timestamps with a time of day."""
    events = tables.read_table(spark, sf_dir, "events").select("event_id", "ts")
    return enrich.derive_calendar(events, replace(ORDERS_MODEL, start="ts"))


# --- aggregates ------------------------------------------------------------------


@query("agg_daily_zone")
def agg_daily_zone(spark, sf_dir):
    return Pipeline(spark, sf_dir).daily


@query("agg_hourly_profile")
def agg_hourly_profile(spark, sf_dir):
    return Pipeline(spark, sf_dir).event_hourly


@query("agg_citywide_borough")
def agg_citywide_borough(spark, sf_dir):
    return Pipeline(spark, sf_dir).series


def _loaded_in_two_steps(spark, sf_dir, transform) -> tuple[Pipeline, str]:
    """A table kept by ``loads`` over month partitions: the months up to the
    middle one first, then the others, as new months of one source."""
    p = Pipeline(spark, sf_dir)
    source, target, ledger = (scratch_path(spark, n) for n in ("months_source", "months_table", "months_ledger"))
    for part in (F.col("pickup_date") < LOAD_SPLIT, F.col("pickup_date") >= LOAD_SPLIT):
        files.write_partitioned(p.trips.filter(part), source, "year_month", only_partitions=True)
        loads.load_partitions(spark, source, target, ledger, "year_month", lambda rows: transform(rows, p.model))
    return p, target


@query("agg_daily_incremental")
def agg_daily_incremental(spark, sf_dir):
    """The daily aggregate merged from partials by month, stored in two loads."""
    p, path = _loaded_in_two_steps(spark, sf_dir, partials.daily_partials)
    return partials.merge_daily(files.read_partitioned(spark, path, "year_month"), p.model)


@query("agg_hourly_incremental")
def agg_hourly_incremental(spark, sf_dir):
    """The hourly profile of trips merged from partials by month: one group has rows of every month."""
    p, path = _loaded_in_two_steps(spark, sf_dir, lambda rows, m: partials.hourly_partials(rows, m.fare))
    return partials.merge_hourly(files.read_partitioned(spark, path, "year_month"), p.model.fare)


@query("agg_active_zones")
def agg_active_zones(spark, sf_dir):
    """Distinct zones of each week, by OR of bitmaps that months keep."""
    _, path = _loaded_in_two_steps(spark, sf_dir, partials.zone_week_bitmaps)
    return partials.active_zones(files.read_partitioned(spark, path, "year_month"))


@query("agg_zone_cohorts")
def agg_zone_cohorts(spark, sf_dir):
    """The weekly cohorts with zones as bitmaps by month."""
    p = Pipeline(spark, sf_dir)
    return partials.merge_cohorts(partials.cohort_bitmaps(p.daily, p.model))


# --- loads -----------------------------------------------------------------------


@query("load_months")
def load_months(spark, sf_dir):
    """Trips loaded month by month, twice: the second load finds nothing new,
    and the table and its counts stay."""
    source, target, ledger = (scratch_path(spark, n) for n in ("trips_cleaned", "trips_loaded", "trips_ledger"))
    files.write_partitioned(Pipeline(spark, sf_dir).trips, source, "year_month")
    first, again = (loads.load_partitions(spark, source, target, ledger, "year_month") for _ in range(2))
    table = files.read_partitioned(spark, target, "year_month").groupBy("year_month").agg(F.count(F.lit(1)).alias("table_rows"))
    renamed = [d.select("year_month", F.col("rows").alias(n)) for d, n in ((first, "rows_loaded"), (again, "rows_loaded_again"))]
    both = table.join(renamed[0], "year_month", "full").join(renamed[1], "year_month", "full")
    return both.fillna(0, ["rows_loaded", "rows_loaded_again", "table_rows"])


# --- views -----------------------------------------------------------------------


@query("view_daily_kpis")
def view_daily_kpis(spark, sf_dir):
    return Pipeline(spark, sf_dir).kpis


@query("view_monthly_trend")
def view_monthly_trend(spark, sf_dir):
    return Pipeline(spark, sf_dir).trend


@query("view_zone_leaderboard")
def view_zone_leaderboard(spark, sf_dir):
    return Pipeline(spark, sf_dir).leaderboard


@query("view_borough_share")
def view_borough_share(spark, sf_dir):
    return views.borough_share(Pipeline(spark, sf_dir).daily)


@query("view_hourly_demand")
def view_hourly_demand(spark, sf_dir):
    return Pipeline(spark, sf_dir).demand


@query("view_anomaly_overlay")
def view_anomaly_overlay(spark, sf_dir):
    return Pipeline(spark, sf_dir).overlay


@query("view_zone_weekly_cohort")
def view_zone_weekly_cohort(spark, sf_dir):
    return views.zone_weekly_cohort(Pipeline(spark, sf_dir).daily)


@query("view_data_quality")
def view_data_quality(spark, sf_dir):
    return views.ordered("vw_data_quality", views.data_quality(Pipeline(spark, sf_dir).checks))


@query("views_published")
def views_published(spark, sf_dir):
    """Rows of the eight views, published by this session and opened by another."""
    p, path, daily = Pipeline(spark, sf_dir), scratch_path(spark, "views"), scratch_path(spark, "daily_zone_agg")
    p.daily.write.mode("overwrite").parquet(daily)
    p.daily = spark.read.parquet(daily)  # the views of this pipeline stand on it
    published.publish_views(spark, {name: build() for name, build in p.view_builders().items()}, path)
    other, rows = spark.newSession(), None
    for name in published.open_views(other, path):
        one = other.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("view_name"), "rows")
        rows = one if rows is None else rows.unionByName(one)
    return rows


# --- anomaly ---------------------------------------------------------------------


@query("anomaly_zscore")
def anomaly_zscore(spark, sf_dir):
    return Pipeline(spark, sf_dir).flags


@query("anomaly_flagged")
def anomaly_flagged(spark, sf_dir):
    return report.flagged(Pipeline(spark, sf_dir).flags)


@query("anomaly_top50")
def anomaly_top50(spark, sf_dir):
    return anomaly.report_lines(anomaly.top_by_abs_z(Pipeline(spark, sf_dir).flags, 50))


@query("anomaly_counts")
def anomaly_counts(spark, sf_dir):
    return anomaly.flag_counts(Pipeline(spark, sf_dir).flags)


# --- quality ---------------------------------------------------------------------


@query("dq_null_rate")
def dq_null_rate(spark, sf_dir):
    return _checks_of(spark, sf_dir, "null")


@query("dq_value_range")
def dq_value_range(spark, sf_dir):
    return _checks_of(spark, sf_dir, "range")


@query("dq_schema")
def dq_schema(spark, sf_dir):
    return _checks_of(spark, sf_dir, "schema", "drift")


@query("dq_duplicate_keys")
def dq_duplicate_keys(spark, sf_dir):
    return _checks_of(spark, sf_dir, "duplicate")


@query("dq_reconcile")
def dq_reconcile(spark, sf_dir):
    return _checks_of(spark, sf_dir, "reconcile")


@query("dq_results")
def dq_results(spark, sf_dir):
    return Pipeline(spark, sf_dir).checks


@query("dq_summary")
def dq_summary(spark, sf_dir):
    return quality.summary(Pipeline(spark, sf_dir).checks)


# --- dashboard -------------------------------------------------------------------


@query("dash_totals")
def dash_totals(spark, sf_dir):
    return views.dash_totals(Pipeline(spark, sf_dir).kpis)


@query("dash_failing_checks")
def dash_failing_checks(spark, sf_dir):
    return views.dash_failing_checks(Pipeline(spark, sf_dir).checks)


@query("dash_daily_series")
def dash_daily_series(spark, sf_dir):
    return views.dash_daily_series(Pipeline(spark, sf_dir).kpis)


@query("dash_monthly")
def dash_monthly(spark, sf_dir):
    return views.dash_monthly(Pipeline(spark, sf_dir).trend)


@query("dash_top_zones")
def dash_top_zones(spark, sf_dir):
    return views.dash_top_zones(Pipeline(spark, sf_dir).leaderboard)


@query("dash_heatmap")
def dash_heatmap(spark, sf_dir):
    return views.dash_heatmap(Pipeline(spark, sf_dir).demand)


@query("dash_anomaly_overlay")
def dash_anomaly_overlay(spark, sf_dir):
    return views.dash_anomaly_overlay(Pipeline(spark, sf_dir).overlay)


# --- report ----------------------------------------------------------------------


@query("report_summary")
def report_summary(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    counts = p.stage_counts  # the checks read the counts that the summary shows
    checks = p.checks_of(quality.FAMILIES, counts)
    return report.summary(p.daily, counts, checks, p.flags, p.model.origin)


@query("report_daily")
def report_daily(spark, sf_dir):
    return report.daily(Pipeline(spark, sf_dir).daily)


@query("report_monthly")
def report_monthly(spark, sf_dir):
    return report.monthly(Pipeline(spark, sf_dir).daily)


@query("report_zone_top25")
def report_zone_top25(spark, sf_dir):
    return report.zone_top(Pipeline(spark, sf_dir).daily)


@query("report_hourly_matrix")
def report_hourly_matrix(spark, sf_dir):
    return report.hourly_matrix(Pipeline(spark, sf_dir).event_hourly)


# --- ad hoc ----------------------------------------------------------------------


@query("weekly_kpis")
def weekly_kpis(spark, sf_dir):
    return Pipeline(spark, sf_dir).kpis.orderBy(F.col("day").desc()).limit(7)


@query("weekly_anomalies")
def weekly_anomalies(spark, sf_dir):
    overlay = Pipeline(spark, sf_dir).overlay
    return (
        overlay.filter("is_anomalous")
        .orderBy(F.col("day").desc(), "grain", "metric")
        .limit(20)
        .select("day", "grain", "metric", "value", "rolling_mean", "z_score")
    )


@query("guarded_query")
def guarded_query(spark, sf_dir):
    """Validate first, then register the curated views the text names, over
    the stored daily aggregate, and hold the query to the cap on bytes."""
    named = adhoc.relations_of(spark, GUARDED_SQL)
    p, path = Pipeline(spark, sf_dir), scratch_path(spark, "daily_zone_agg")
    p.daily.write.mode("overwrite").parquet(path)
    p.daily = spark.read.parquet(path)  # the views of this pipeline stand on it
    p.register_views([v for v in views.VIEW_NAMES if v in named])
    return adhoc.guarded_query(spark, GUARDED_SQL, views.VIEW_NAMES)


# --- layout ----------------------------------------------------------------------


@query("layout_clustered_query")
def layout_clustered_query(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    path = scratch_path(spark, "trips_clustered")
    layout.write_clustered(p.trips, path, p.model)
    table = spark.read.parquet(path)
    return layout.zone_period_query(table, p.model, LAYOUT_ZONE, LAYOUT_START, LAYOUT_END)


@query("layout_naive_query")
def layout_naive_query(spark, sf_dir):
    p = Pipeline(spark, sf_dir)
    path = scratch_path(spark, "trips_plain")
    layout.write_plain(p.trips, path)
    table = spark.read.parquet(path)
    return layout.zone_period_query(table, p.model, LAYOUT_ZONE, LAYOUT_START, LAYOUT_END, None)


@query("layout_interleaved_query")
def layout_interleaved_query(spark, sf_dir):
    """The layout query on rows clustered by zone and date at once."""
    p = Pipeline(spark, sf_dir)
    path = scratch_path(spark, "trips_interleaved")
    layout.write_interleaved(p.trips, path, p.model)
    table = spark.read.parquet(path)
    return layout.zone_period_query(table, p.model, LAYOUT_ZONE, LAYOUT_START, LAYOUT_END, None)
