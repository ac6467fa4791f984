"""Command line for the batch stages over real trip files.

    python -m tripline.cli etl      --raw 'data/raw/trips_*.parquet' \\
                                    --zones data/raw/zones.csv --out data/processed
    python -m tripline.cli validate --raw '...' --out data/processed --report reports/validation
    python -m tripline.cli anomaly  --out data/processed --report reports/anomaly_report
    python -m tripline.cli ask      --out data/processed --checks reports/validation "SELECT ..."
    python -m tripline.cli publish  --out data/processed --checks reports/validation --views data/views
    python -m tripline.cli ask      --views data/views "SELECT ..."
    python -m tripline.cli report   --out data/processed --report reports/tables --checks reports/validation
    python -m tripline.cli layout   --out data/processed --zone 132 --start 2023-07-01 --end 2023-07-31

Every stage is a Spark job; the driver only prints small results.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.model import TAXI_ALIASES, TAXI_CANONICAL, TAXI_MODEL
from tripline.operators import quality
from tripline.plans import adhoc, etl, layout, published, scanlog, views
from tripline.session import build_session
from tripline.sources import drift, files


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripline")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True, help="glob of monthly Parquet files")
    e.add_argument("--zones", required=True, help="zone lookup CSV")
    e.add_argument("--out", required=True)
    v = sub.add_parser("validate")
    v.add_argument("--raw", required=True)
    for stage in (e, v):
        stage.add_argument("--months", help="1-12 or 1,3,5: fills a {month} in --raw")
    v.add_argument("--out", required=True)
    v.add_argument("--report")
    a = sub.add_parser("anomaly")
    a.add_argument("--out", required=True)
    a.add_argument("--report")
    q = sub.add_parser("ask")
    source = q.add_mutually_exclusive_group(required=True)
    source.add_argument("--out")
    source.add_argument("--views", help="folder of published views")
    u = sub.add_parser("publish")
    u.add_argument("--out", required=True)
    u.add_argument("--views", required=True, help="folder of published views")
    for stage in (q, u):
        stage.add_argument("--checks", help="validation report folder (for vw_data_quality)")
    q.add_argument("sql")
    lay = sub.add_parser("layout")
    lay.add_argument("--out", required=True)
    lay.add_argument("--zone", type=int, default=132)
    lay.add_argument("--start", default="2023-07-01")
    lay.add_argument("--end", default="2023-07-31")
    lay.add_argument("--partition", choices=("month", "day"), default="month")
    lay.add_argument("--report", help="where the measurement is stored, as JSON")
    lay.add_argument("--events", help="existing folder for Spark's event log: reports the bytes really read")
    r = sub.add_parser("report")
    r.add_argument("--out", required=True)
    r.add_argument("--report", required=True, help="folder of the report tables")
    r.add_argument("--checks", help="validation report folder")
    r.add_argument("--layout", help="layout report folder")
    return p


def _event_log(args: argparse.Namespace) -> dict[str, str]:
    """Session settings for the bytes that the layout benchmark reports."""
    if args.cmd != "layout" or not args.events:
        return {}
    return {**scanlog.EVENT_LOG_CONF, "spark.eventLog.dir": args.events}


def _stored_views(spark: SparkSession, out: str, checks_path: str | None) -> tuple[DataFrame, ...]:
    """The stored tables that the views stand on."""
    checks = etl.load_checks(spark, checks_path) if checks_path else spark.createDataFrame([], etl.CHECK_SCHEMA)
    tables = ("daily_zone_agg", "hourly_profile", "anomaly_flags")
    return *(spark.read.parquet(f"{out.rstrip('/')}/{t}") for t in tables), checks


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    args = _parser().parse_args(argv)
    if spark is None:
        spark = build_session(app_name=f"tripline-{args.cmd}", extra_conf=_event_log(args))
    if args.cmd == "etl":
        paths = files.select_files(spark, args.raw, args.months)
        raw = drift.read_aligned(spark, paths, TAXI_CANONICAL, TAXI_ALIASES)
        lacking = drift.drift_messages(drift.drift_frame(spark, paths, TAXI_CANONICAL, TAXI_ALIASES))
        zones = files.read_zone_csv(spark, args.zones)
        manifest = etl.run_etl(spark, raw, zones, TAXI_MODEL, args.out, lacking)
        print(json.dumps(manifest, indent=2))
        return manifest
    if args.cmd == "validate":
        ingest = files.ingest_manifest(spark, files.select_files(spark, args.raw, args.months))
        files.assert_ingested(ingest)
        total = ingest.agg(F.sum("rows").alias("ingest_total_rows"))
        checks = etl.run_validation(spark, args.out, TAXI_MODEL, total, args.report, gate=False)
        outcome = F.when(F.col("passed"), "ok").otherwise(F.col("severity"))
        rows = checks.withColumn("outcome", outcome).collect()  # the fixed list of check rows
        print("\n".join(f"{r.outcome:8} {r.name}  {r.detail}" for r in rows))
        if stopped := [r.name for r in rows if r.outcome == "error"]:
            raise RuntimeError("failed data-quality checks: " + ", ".join(stopped))
        return rows
    if args.cmd == "anomaly":
        flags = etl.run_anomaly(spark, args.out, args.report)
        counts = flags.agg(F.count(F.lit(1)), F.count_if("is_anomalous")).first()
        print(f"scored {counts[0]:,} points, {counts[1]:,} flagged")
        return counts
    if args.cmd == "report":
        names = etl.run_reports(spark, args.out, args.report, TAXI_MODEL, args.checks, args.layout)
        print("wrote " + ", ".join(names))
        return names
    if args.cmd == "ask":
        if args.views:
            published.open_views(spark, args.views)
        else:
            views.register_stored(*_stored_views(spark, args.out, args.checks))
        df = adhoc.guarded_query(spark, args.sql, views.VIEW_NAMES)
        df.show(adhoc.RESULT_ROW_LIMIT, truncate=False)
        return df
    if args.cmd == "publish":
        frames = views.stored_frames(*_stored_views(spark, args.out, args.checks))
        version = published.publish_views(spark, frames, args.views)
        print(f"published {len(frames)} views as {version}")
        return version
    if args.cmd == "layout":
        out = args.out.rstrip("/")
        trips = files.read_partitioned(spark, f"{out}/trips_cleaned", "year_month")
        part = layout.DAY_COL if args.partition == "day" else layout.PARTITION_COL
        layout.write_clustered(trips, f"{out}/trips_clustered", TAXI_MODEL, part)
        layout.write_plain(trips, f"{out}/trips_plain")
        report = layout.benchmark(spark, f"{out}/trips_clustered", f"{out}/trips_plain", TAXI_MODEL,
                                  args.zone, args.start, args.end, part)
        row = report.first().asDict()
        if args.report:
            spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(args.report)
        print(json.dumps(row, indent=2))
        return row
    raise SystemExit(2)


if __name__ == "__main__":
    main(sys.argv[1:])
