"""Sources and sinks: drift reader, CSV dimension, manifests, partitions."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import taxi_frame, taxi_row
from tripline.model import TAXI_ALIASES, TAXI_CANONICAL
from tripline.sources import drift, files, footers


def write_month(spark, path, rows, vendor_type="bigint", rename=None, drop=()):
    df = taxi_frame(spark, rows).withColumn("VendorID", F.col("VendorID").cast(vendor_type))
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    df.drop(*drop).coalesce(1).write.parquet(path)


def test_drift_reader_aligns_types_aliases_and_missing(spark, tmp_dir):
    a, b, c = (f"{tmp_dir}/trips_2023-0{i}.parquet" for i in (1, 2, 3))
    write_month(spark, a, [taxi_row()], vendor_type="int", rename={"airport_fee": "Airport_fee"})
    write_month(spark, b, [taxi_row(), taxi_row(VendorID=2)], drop=("congestion_surcharge",))
    write_month(spark, c, [taxi_row(VendorID=3)], vendor_type="int", rename={"airport_fee": "Airport_fee"})
    groups = drift.schema_groups(spark, [a, b, c], TAXI_CANONICAL, TAXI_ALIASES)
    assert len(groups) == 2  # two physical schemas -> two scans, not three
    assert sorted(len(g.paths) for g in groups) == [1, 2]
    assert [n for g in groups for n, column in g.held.items() if column is None] == ["congestion_surcharge"]
    df = drift.read_aligned(spark, [a, b, c], TAXI_CANONICAL, TAXI_ALIASES)
    assert df.count() == 4
    assert dict(df.dtypes)["VendorID"] == "bigint"
    assert [n for n, _ in TAXI_CANONICAL] == df.columns
    assert df.filter("airport_fee IS NULL").count() == 0  # alias resolved
    found = drift.drift_frame(spark, [a, b, c], TAXI_CANONICAL, TAXI_ALIASES)
    row = found.collect()[0]
    assert found.count() == 1 and row.column_name == "congestion_surcharge" and row.file_name.endswith(".parquet")
    assert drift.drift_messages(found).collect()[0].message == (
        f"{row.file_name}: missing column 'congestion_surcharge' (filled null)"
    )
    assert drift.failed_values(spark, [a, b, c], TAXI_CANONICAL, TAXI_ALIASES).count() == 0


def test_folders_and_any_number_of_files(spark, tmp_dir):
    dirs = [f"{tmp_dir}/m{i}" for i in range(70)]
    write_month(spark, dirs[0], [taxi_row()], vendor_type="int")
    write_month(spark, dirs[1], [taxi_row(), taxi_row(VendorID=2)])
    for copy in dirs[2:]:
        shutil.copytree(dirs[1], copy)
    df = drift.read_aligned(spark, dirs, TAXI_CANONICAL, TAXI_ALIASES)
    assert df.count() == 1 + 69 * 2
    assert drift.drift_frame(spark, dirs[:2], TAXI_CANONICAL, TAXI_ALIASES).count() == 0


def test_ten_thousand_small_files_take_a_bounded_number_of_jobs(spark, tmp_dir):
    kinds = []
    for name, change in (("a", {}), ("b", {"vendor_type": "int"}), ("c", {"drop": ("extra",)})):
        write_month(spark, f"{tmp_dir}/{name}", [taxi_row()], **change)
        kinds.append(next(f"{tmp_dir}/{name}/{f}" for f in os.listdir(f"{tmp_dir}/{name}") if f.startswith("part-")))
    os.mkdir(f"{tmp_dir}/many")
    for i in range(10_000):
        os.link(kinds[i % 3 if i % 100 == 0 else 0], f"{tmp_dir}/many/trips_{i:05d}.parquet")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many-footers", "footers of many files")
    try:
        paths = sorted(f"{tmp_dir}/many/{f}" for f in os.listdir(f"{tmp_dir}/many"))
        groups = drift.schema_groups(spark, paths, TAXI_CANONICAL, TAXI_ALIASES)
        assert sorted(len(g.paths) for g in groups) == [33, 33, 9934]
        assert len(jobs.getJobIdsForGroup("many-footers")) <= 8
        lacking = drift.drift_frame(spark, paths[:301], TAXI_CANONICAL, TAXI_ALIASES)
        assert [r.column_name for r in lacking.collect()] == ["extra"]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_footers_tell_rows_and_column_sizes(spark, tmp_dir):
    spark.range(5000).selectExpr("id", "cast(id as string) as text").coalesce(1).write.parquet(f"{tmp_dir}/x")
    found = footers.footers(spark, [f"{tmp_dir}/x"]).collect()
    assert [r.rows for r in found] == [5000]
    sizes = {c.name: c.bytes for c in found[0].columns}
    assert set(sizes) == {"id", "text"} and 0 < sum(sizes.values()) < found[0].bytes
    total = footers.column_bytes(footers.footers(spark, [f"{tmp_dir}/x"]), ["text"]).collect()
    assert [(r.column_name, r.files, r.bytes) for r in total] == [("text", 1, sizes["text"])]


def test_footers_of_stores_that_tasks_cannot_open(spark, tmp_dir, monkeypatch):
    write_month(spark, f"{tmp_dir}/a", [taxi_row()], drop=("extra",))
    monkeypatch.setattr(footers, "tasks_can_open", lambda uri: False)
    found = drift.drift_frame(spark, [f"{tmp_dir}/a"], TAXI_CANONICAL, TAXI_ALIASES).collect()
    assert [r.column_name for r in found] == ["extra"]


def test_text_that_is_no_number_becomes_null(spark, tmp_dir):
    path = f"{tmp_dir}/dirty.parquet"
    spark.createDataFrame([("N/A",), ("3",)], "VendorID string").write.parquet(path)
    df = drift.read_aligned(spark, [path], TAXI_CANONICAL, TAXI_ALIASES)
    failed = drift.failed_values(spark, [path], TAXI_CANONICAL, TAXI_ALIASES)
    assert {r.column_name: r.failed for r in failed.collect()} == {"VendorID": 1}
    assert sorted(r.VendorID or 0 for r in df.collect()) == [0, 3]


def test_empty_input_is_rejected(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        files.select_files(spark, f"{tmp_dir}/trips_*.parquet")
    with pytest.raises(ValueError):
        drift.read_aligned(spark, [], TAXI_CANONICAL)


def test_months():
    assert files.months_of("1-12") == list(range(1, 13))
    assert files.months_of("1,3,5") == [1, 3, 5] and files.months_of("7") == [7]
    for bad in ("1-3,5", "0-4", "13", "5-2", "", "x"):
        with pytest.raises(ValueError):
            files.months_of(bad)


def test_files_of_some_months(spark, tmp_dir):
    for m in (1, 2, 3):
        open(f"{tmp_dir}/trips_0{m}.parquet", "w").close()
    found = files.select_files(spark, f"{tmp_dir}/trips_{{month}}.parquet", "2-3")
    assert [os.path.basename(f) for f in found] == ["trips_02.parquet", "trips_03.parquet"]
    assert len(files.select_files(spark, f"{tmp_dir}/trips_*.parquet")) == 3


def test_zone_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n')
        fh.write('1,"EWR","Newark Airport","EWR"\n')
        fh.write('56,"Queens","Corona, North","Boro Zone"\n')
        fh.write('264,"Unknown","N/A","N/A"\n')
    out = {r.zone_id: r for r in files.read_zone_csv(spark, path).collect()}
    assert out[56].zone == "Corona, North"
    assert out[264].zone == "N/A"
    assert out[1].borough == "EWR"


def test_json_report_missing_and_required(spark, tmp_dir):
    assert files.read_json_report(spark, f"{tmp_dir}/nope.json") is None
    with pytest.raises(FileNotFoundError):
        files.read_json_report(spark, f"{tmp_dir}/nope.json", required=True)


def test_ingest_manifest_counts_rows_per_file(spark, tmp_dir):
    a, b = f"{tmp_dir}/m1", f"{tmp_dir}/m2"
    write_month(spark, a, [taxi_row()] * 3)
    write_month(spark, b, [taxi_row()] * 2)
    out = files.ingest_manifest(spark, [a, b]).collect()
    assert sorted(r.rows for r in out) == [2, 3]
    assert not any(r.in_bounds for r in out)
    assert sorted(r.warning.split(": ")[1] for r in out) == [
        "row count 2 outside expected sanity range", "row count 3 outside expected sanity range"
    ]
    assert files.assert_ingested(files.ingest_manifest(spark, [a, b])) == 5
    assert all(r.bytes > 0 for r in out)


def test_ingest_manifest_tells_same_names_apart_and_lists_empty_files(spark, tmp_dir):
    paths = []
    for name, n in (("y1", 3), ("y2", 5), ("y3", 0)):
        write_month(spark, f"{tmp_dir}/{name}-out", [taxi_row()] * n)
        part = next(f for f in os.listdir(f"{tmp_dir}/{name}-out") if f.startswith("part-"))
        os.mkdir(f"{tmp_dir}/{name}")
        paths.append(f"{tmp_dir}/{name}/part-0.parquet")
        shutil.copy(f"{tmp_dir}/{name}-out/{part}", paths[-1])
    out = {r.file_path.split("/")[-2]: r for r in files.ingest_manifest(spark, paths).collect()}
    assert {k: r.rows for k, r in out.items()} == {"y1": 3, "y2": 5, "y3": 0}
    assert out["y3"].warning and all(r.file_name == "part-0.parquet" for r in out.values())
    assert {k: r.bytes for k, r in out.items()} == {p.split("/")[-2]: os.path.getsize(p) for p in paths}


def test_partitioned_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame(
        [("2023-01", 1), ("2023-01", 2), ("2023-02", 3)], "year_month string, v int"
    )
    files.write_partitioned(df, f"{tmp_dir}/p", "year_month", ("v",))
    back = files.read_partitioned(spark, f"{tmp_dir}/p", "year_month")
    assert dict(back.dtypes)["year_month"] == "string"
    got = {r.year_month: r.n for r in back.groupBy("year_month").agg(F.count("*").alias("n")).collect()}
    assert got == {"2023-01": 2, "2023-02": 1}
    assert {"year_month=2023-01", "year_month=2023-02"} <= set(os.listdir(f"{tmp_dir}/p"))
