"""Batch jobs: ETL (clean -> dedupe -> enrich -> write -> aggregate) and
validation (checks over the written tables -> report -> gate).

Step counts and the checks' NULL and range counts come from ``Observation``
metrics attached to the writes, so the job runs 1 scan-only count + 3 writes
instead of re-running the plan for every count, and validation needs no pass
over the stored trips for them.  Aggregates are computed from the *written* trip table, which
cuts the lineage: a lost executor re-reads stored files instead of
recomputing the whole cleaning plan.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from tripline.functions import fill
from tripline.model import TripModel
from tripline.operators import aggregates, anomaly, clean, enrich, quality, report
from tripline.sources.files import read_json_report, read_partitioned, write_partitioned

STEP_NAMES = (
    "raw_rows_read",
    "invalid_rows_dropped",
    "duplicate_rows_dropped",
    "final_cleaned_rows",
    "daily_zone_agg_rows",
    "hourly_profile_rows",
)

MANIFEST_SCHEMA = StructType(
    [
        StructField("steps", StructType([StructField(n, LongType()) for n in STEP_NAMES])),
        StructField("schema_drift", ArrayType(StringType())),
        StructField("elapsed_seconds", DoubleType()),
        StructField("profile", MapType(StringType(), LongType())),
    ]
)

CHECK_SCHEMA = "name string, severity string, passed boolean, detail string"


def _count(obs: Observation) -> int:
    return int(obs.get["rows"])


def run_etl(
    spark: SparkSession,
    raw: DataFrame,
    zones: DataFrame,
    model: TripModel,
    out_dir: str,
    drift: DataFrame | None = None,
) -> dict:
    """Write trips_cleaned (month partitions), daily_zone_agg, hourly_profile
    and etl_manifest under ``out_dir``; return the manifest as a dict."""
    t0 = time.time()
    out_dir = out_dir.rstrip("/")
    raw_rows = raw.count()  # column-free scan: reads row counts only

    obs_valid = Observation("valid_rows")
    valid = clean.clean(raw, model).observe(obs_valid, F.count(F.lit(1)).alias("rows"))
    trips = enrich.enrich(clean.dedupe(valid), zones, model)
    obs_final = Observation("final_rows")
    write_partitioned(
        trips.observe(obs_final, *quality.profile_metrics(trips, model)),
        f"{out_dir}/trips_cleaned",
        "year_month",
        (model.origin, model.payment),
    )
    stored = read_partitioned(spark, f"{out_dir}/trips_cleaned", "year_month")

    obs_daily = Observation("daily_rows")
    aggregates.daily_zone(stored, model).observe(
        obs_daily, F.count(F.lit(1)).alias("rows")
    ).write.mode("overwrite").parquet(f"{out_dir}/daily_zone_agg")
    obs_hourly = Observation("hourly_rows")
    aggregates.hourly_profile(stored, model.fare).observe(
        obs_hourly, F.count(F.lit(1)).alias("rows")
    ).write.mode("overwrite").parquet(f"{out_dir}/hourly_profile")

    valid_rows, final_rows = _count(obs_valid), _count(obs_final)
    manifest = {
        "steps": {
            "raw_rows_read": raw_rows,
            "invalid_rows_dropped": raw_rows - valid_rows,
            "duplicate_rows_dropped": valid_rows - final_rows,
            "final_cleaned_rows": final_rows,
            "daily_zone_agg_rows": _count(obs_daily),
            "hourly_profile_rows": _count(obs_hourly),
        },
        # files x missing columns, never rows
        "schema_drift": sorted(r[0] for r in drift.collect()) if drift is not None else [],
        "elapsed_seconds": round(time.time() - t0, 1),
        "profile": {name: int(value) for name, value in obs_final.get.items()},
    }
    write_manifest(spark, manifest, f"{out_dir}/etl_manifest")
    return manifest


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """One JSON document, written by Spark (one small file)."""
    row = (
        tuple(manifest["steps"].get(n) for n in STEP_NAMES),
        manifest.get("schema_drift", []),
        float(manifest.get("elapsed_seconds", 0.0)),
        manifest.get("profile"),
    )
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """ETL manifest -> ``(name, value)`` step counts (no collect)."""
    steps = manifest.select("steps.*")
    return steps.unpivot([], list(steps.columns), "name", "value")


def manifest_profile(manifest: DataFrame) -> DataFrame | None:
    """The trips' metrics of an ETL manifest as ``(name, value)``; None in one that has none."""
    rows = manifest.select(F.explode("profile").alias("name", "value"))
    return None if rows.isEmpty() else rows


def run_validation(
    spark: SparkSession,
    out_dir: str,
    model: TripModel,
    ingest_total_rows: DataFrame,
    report_path: str | None = None,
    gate: bool = True,
) -> DataFrame:
    """Checks over the ETL outputs.  ``ingest_total_rows`` is a one-row frame
    with that column (e.g. from ``files.ingest_manifest``).  Writes the JSON
    report when ``report_path`` is given and raises on failed errors when
    ``gate``.  Returns the checks DataFrame."""
    out_dir = out_dir.rstrip("/")
    manifest = read_json_report(spark, f"{out_dir}/etl_manifest", MANIFEST_SCHEMA, required=True)
    drift = manifest.select(F.explode("schema_drift").alias("message"))
    counts = manifest_counts(manifest).filter(
        F.col("name").isin("raw_rows_read", "final_cleaned_rows")
    ).unionByName(
        ingest_total_rows.select(
            F.lit("ingest_total_rows").alias("name"),
            F.col("ingest_total_rows").cast("bigint").alias("value"),
        )
    )
    trips = read_partitioned(spark, f"{out_dir}/trips_cleaned", "year_month")
    daily = spark.read.parquet(f"{out_dir}/daily_zone_agg")
    hourly = spark.read.parquet(f"{out_dir}/hourly_profile")
    checks = quality.run_checks(trips, daily, hourly, counts, model, drift, profile=manifest_profile(manifest))
    if report_path:
        write_report(checks, report_path)
        checks = spark.read.option("multiLine", True).json(report_path).select(
            F.explode("checks").alias("c")
        ).select("c.*").select("name", "severity", "passed", "detail")
    if gate:
        quality.assert_no_failed_errors(checks)
    return checks


def write_report(checks: DataFrame, path: str) -> None:
    """``{checks: [...], total, passed, failed_errors, failed_warnings}`` as
    one JSON document.  The check list is a fixed, small set of rows."""
    failed = ~F.col("passed")
    checks.agg(
        F.collect_list(F.struct("name", "severity", "passed", "detail")).alias("checks"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(failed & (F.col("severity") == "error")).alias("failed_errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("failed_warnings"),
    ).coalesce(1).write.mode("overwrite").json(path)


def load_checks(spark: SparkSession, report_path: str) -> DataFrame:
    """Flatten a validation report into the 4-column checks table; a missing
    report or an empty check list gives an empty table."""
    found = read_json_report(spark, report_path)
    if found is None or "checks" not in found.columns:
        return spark.createDataFrame([], CHECK_SCHEMA)
    return found.select(F.explode("checks").alias("c")).select(
        "c.name", "c.severity", F.col("c.passed").cast("boolean").alias("passed"), "c.detail"
    )


def run_anomaly(spark: SparkSession, out_dir: str, report_path: str | None = None) -> DataFrame:
    """Score the stored daily aggregate and write ``anomaly_flags`` (and the
    text report when ``report_path`` is given).  Returns the stored flags."""
    out_dir = out_dir.rstrip("/")
    daily = spark.read.parquet(f"{out_dir}/daily_zone_agg")
    flags = anomaly.anomalies(aggregates.citywide_and_borough(daily))
    flags.write.mode("overwrite").parquet(f"{out_dir}/anomaly_flags")
    stored = spark.read.parquet(f"{out_dir}/anomaly_flags")
    if report_path:
        write_anomaly_report(stored, report_path)
    return stored


def run_reports(
    spark: SparkSession, out_dir: str, path: str, model: TripModel,
    checks_path: str | None = None, layout_path: str | None = None,
) -> list[str]:
    """Write the report tables over the stored outputs as Parquet folders under
    ``path``; returns their names.  The checks and the layout benchmark come
    from their own stored reports, where there are any."""
    out_dir, path = out_dir.rstrip("/"), path.rstrip("/")
    daily, hourly, flags = (
        spark.read.parquet(f"{out_dir}/{t}") for t in ("daily_zone_agg", "hourly_profile", "anomaly_flags")
    )
    manifest = read_json_report(spark, f"{out_dir}/etl_manifest", MANIFEST_SCHEMA, required=True)
    checks = load_checks(spark, checks_path) if checks_path else spark.createDataFrame([], CHECK_SCHEMA)
    measured = read_json_report(spark, layout_path) if layout_path else None
    frames = {
        "summary": report.summary(daily, manifest_counts(manifest), checks, flags, model.origin, measured),
        "daily": report.daily(daily),
        "monthly": report.monthly(daily),
        "zone_top": report.zone_top(daily),
        "hourly_matrix": report.hourly_matrix(hourly),
        "anomalies": report.flagged(flags),
        "checks": checks,
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
    return list(frames)


def write_anomaly_report(flags: DataFrame, path: str, top_n: int = 50) -> None:
    """Markdown report: method line, totals, then the top |z| points.  The
    text is built from one aggregate row and at most ``top_n`` point rows."""
    counts = anomaly.flag_counts(flags)
    parts = {
        "window": anomaly.ROLLING_WINDOW_OCCURRENCES,
        "threshold": anomaly.Z_THRESHOLD,
        "scored": F.format_number("points_scored", 0),
        "flagged": F.format_number("points_flagged", 0),
    }
    head = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("seq"), fill(line, **parts).alias("value"))
                    for i, line in enumerate(anomaly.REPORT_HEADER)
                ]
            )
        )
    )
    top = anomaly.top_by_abs_z(flags, top_n)
    order = [F.abs("z_score").desc(), "pickup_date", "grain", "metric"]
    lines = anomaly.report_lines(top).select(
        (F.lit(len(anomaly.REPORT_HEADER)) + F.row_number().over(Window.orderBy(*order))).alias("seq"),
        F.col("line").alias("value"),
    )
    head.unionByName(lines).orderBy("seq").coalesce(1).select("value").write.mode("overwrite").text(path)
