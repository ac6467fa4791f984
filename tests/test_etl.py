"""End-to-end batch jobs on hand-made monthly files."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_text, taxi_frame, taxi_row, ts, zone_frame
from tripline.model import TAXI_ALIASES, TAXI_CANONICAL, TAXI_MODEL
from tripline.operators import quality
from tripline.plans import etl
from tripline.sources import drift, files


def month_rows(month, n):
    return [
        taxi_row(
            VendorID=1 + i % 2,
            tpep_pickup_datetime=ts(f"2023-0{month}-{1 + i % 27:02d} {i % 24:02d}:05:00"),
            tpep_dropoff_datetime=ts(f"2023-0{month}-{1 + i % 27:02d} {i % 24:02d}:35:00"),
            PULocationID=(132, 236, 1)[i % 3],
            total_amount=10.0 + i,
            fare_amount=8.0 + i,
        )
        for i in range(n)
    ]


@pytest.fixture()
def job(spark, tmp_dir):
    paths = []
    for m, n in ((1, 30), (2, 20)):
        p = f"{tmp_dir}/raw/trips_2023-0{m}.parquet"
        rows = month_rows(m, n) + [taxi_row(fare_amount=-1.0)]  # one invalid row per month
        if m == 2:
            rows.append(rows[0])  # one exact duplicate
        df = taxi_frame(spark, rows)
        if m == 1:
            df = df.withColumnRenamed("airport_fee", "Airport_fee")
        df.coalesce(1).write.parquet(p)
        paths.append(p)
    raw = drift.read_aligned(spark, paths, TAXI_CANONICAL, TAXI_ALIASES)
    lacking = drift.drift_messages(drift.drift_frame(spark, paths, TAXI_CANONICAL, TAXI_ALIASES))
    out = f"{tmp_dir}/processed"
    manifest = etl.run_etl(spark, raw, zone_frame(spark), TAXI_MODEL, out, lacking)
    return spark, paths, out, manifest


def test_etl_step_counts(job):
    spark, paths, out, manifest = job
    assert manifest["steps"] == {
        "raw_rows_read": 53,
        "invalid_rows_dropped": 2,
        "duplicate_rows_dropped": 1,
        "final_cleaned_rows": 50,
        "daily_zone_agg_rows": manifest["steps"]["daily_zone_agg_rows"],
        "hourly_profile_rows": manifest["steps"]["hourly_profile_rows"],
    }
    daily = spark.read.parquet(f"{out}/daily_zone_agg")
    assert daily.count() == manifest["steps"]["daily_zone_agg_rows"]
    assert daily.agg(F.sum("trip_count")).first()[0] == 50
    stored = files.read_partitioned(spark, f"{out}/trips_cleaned", "year_month")
    assert sorted(r.year_month for r in stored.select("year_month").distinct().collect()) == [
        "2023-01", "2023-02"
    ]
    m = spark.read.json(f"{out}/etl_manifest").first()
    assert m.steps.final_cleaned_rows == 50


def test_validation_passes_and_reports(job, tmp_dir):
    spark, paths, out, manifest = job
    ingest = files.ingest_manifest(spark, paths).agg(F.sum("rows").alias("ingest_total_rows"))
    checks = etl.run_validation(spark, out, TAXI_MODEL, ingest, report_path=f"{tmp_dir}/report")
    got = {r.name: r for r in checks.collect()}
    assert len(got) == 14
    assert all(r.passed for r in got.values() if r.severity == "error")
    assert got["row_count_reconciliation[ingest_to_etl_read]"].detail == (
        "ingest.total_rows=53 vs etl.raw_rows_read=53"
    )
    loaded = etl.load_checks(spark, f"{tmp_dir}/report")
    assert loaded.count() == 14
    assert etl.load_checks(spark, f"{tmp_dir}/missing").count() == 0


def test_validation_gate_fails_on_mismatch(job):
    spark, paths, out, manifest = job
    wrong = spark.createDataFrame([(54,)], "ingest_total_rows bigint")
    with pytest.raises(RuntimeError, match="ingest_to_etl_read"):
        etl.run_validation(spark, out, TAXI_MODEL, wrong)


def test_anomaly_job_writes_flags_and_report(job, tmp_dir):
    spark, paths, out, manifest = job
    flags = etl.run_anomaly(spark, out, report_path=f"{tmp_dir}/anomaly_report")
    assert flags.count() > 0
    assert set(flags.columns) == {
        "pickup_date", "grain_type", "grain", "metric", "value", "rolling_mean", "rolling_std", "z_score", "is_anomalous"
    }
    lines = [r.value for r in spark.read.text(f"{tmp_dir}/anomaly_report").collect()]
    assert lines[0] == "# Anomaly Detection Report"
    assert lines[4].startswith("Total (grain, metric, date) points scored: ")
    assert lines[7] == "| Date | Grain | Metric | Value | Rolling Mean | Z-score |"


def test_cli_stages_end_to_end(spark, tmp_dir):
    from tripline import cli

    raw_dir = f"{tmp_dir}/raw"
    for m, n in ((1, 12), (2, 9)):
        taxi_frame(spark, month_rows(m, n)).coalesce(1).write.parquet(
            f"{raw_dir}/trips_2023-0{m}.parquet"
        )
    zones_csv = f"{tmp_dir}/zones.csv"
    with open(zones_csv, "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n")
        fh.write("132,Queens,JFK Airport,Airports\n236,Manhattan,Upper East Side North,Yellow Zone\n")
    out, glob_ = f"{tmp_dir}/processed", f"{raw_dir}/trips_*.parquet"
    manifest = cli.main(["etl", "--raw", glob_, "--zones", zones_csv, "--out", out], spark)
    assert manifest["steps"]["final_cleaned_rows"] == 21
    rows = cli.main(["validate", "--raw", glob_, "--out", out, "--report", f"{tmp_dir}/val"], spark)
    assert len(rows) == 14
    cli.main(["anomaly", "--out", out], spark)
    df = cli.main(["ask", "--out", out, "--checks", f"{tmp_dir}/val",
                   "SELECT name, passed FROM vw_data_quality"], spark)
    assert df.count() == 14
    cli.main(["publish", "--out", out, "--checks", f"{tmp_dir}/val", "--views", f"{tmp_dir}/views"], spark)
    asked = cli.main(["ask", "--views", f"{tmp_dir}/views", "SELECT name, passed FROM vw_data_quality"], spark.newSession())
    assert sorted(asked.collect()) == sorted(df.collect())
    row = cli.main(["layout", "--out", out, "--zone", "132", "--start", "2023-01-01",
                    "--end", "2023-01-31", "--report", f"{tmp_dir}/layout"], spark)
    names = cli.main(["report", "--out", out, "--report", f"{tmp_dir}/tables", "--checks", f"{tmp_dir}/val",
                      "--layout", f"{tmp_dir}/layout"], spark)
    assert len(names) == 7 and all(spark.read.parquet(f"{tmp_dir}/tables/{n}").columns for n in names)
    head = spark.read.parquet(f"{tmp_dir}/tables/summary").first()
    assert head.total_trips == 21 and head.checks_total == 14
    assert head.wall_clock_speedup_x == row["wall_clock_speedup_x"]
    assert row["clustered_files"] <= row["naive_files"] + 1


def test_checks_of_a_run_take_no_pass_over_the_trips_for_nulls_and_ranges(job, tmp_dir):
    spark, paths, out, manifest = job
    model, ingest = TAXI_MODEL, spark.createDataFrame([(53,)], "ingest_total_rows bigint")
    stored = files.read_partitioned(spark, f"{out}/trips_cleaned", "year_month")
    again = {k: v for k, v in quality.trip_profile(stored, model).first().asDict().items()}
    assert manifest["profile"] == again  # as observed at the write

    def checked():
        """The checks, and the scans of the trips that read the fare."""
        df = etl.run_validation(spark, out, model, ingest, gate=False)
        blocks = [b for b in plan_text(df).split("Scan parquet")[1:] if "ReadSchema" in b and "trips_cleaned" in b]
        return sorted(map(str, df.collect())), sum(model.fare in b.split("ReadSchema")[1].split("\n")[0] for b in blocks)

    observed, passes = checked()
    etl.write_manifest(spark, {**manifest, "profile": None}, f"{out}/etl_manifest")
    assert passes == 0 and checked() == (observed, 1)
