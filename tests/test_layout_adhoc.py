"""Clustered vs plain layout, pruning helper, scan metrics; guarded SQL."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan_text, taxi_frame, taxi_row, zone_frame
from tripline.model import TAXI_MODEL as M
from tripline.operators import enrich
from tripline.plans import adhoc, layout, scanlog


@pytest.fixture()
def trips(spark):
    rows = []
    for month in (5, 6, 7, 8):
        for day in (1, 11, 21):
            for zone in (132, 236, 1):
                p = dt.datetime(2023, month, day, 9, 0)
                rows.append(taxi_row(tpep_pickup_datetime=p, tpep_dropoff_datetime=p + dt.timedelta(minutes=30),
                                     PULocationID=zone, total_amount=10.0 + day, trip_distance=1.0 + zone % 5))
    return enrich.enrich(taxi_frame(spark, rows), zone_frame(spark), M)


def test_clustered_and_plain_answer_the_same(spark, trips, tmp_dir):
    c, p = f"{tmp_dir}/clustered", f"{tmp_dir}/plain"
    layout.write_clustered(trips, c, M)
    layout.write_plain(trips, p)
    a = layout.zone_period_query(spark.read.parquet(c), M, 132, "2023-07-01", "2023-07-31")
    b = layout.zone_period_query(spark.read.parquet(p), M, 132, "2023-07-01", "2023-07-31", None)
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 3
    plan = plan_text(a)
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_day_partitions_prune_on_the_date(spark, trips, tmp_dir):
    d, p = f"{tmp_dir}/by_day", f"{tmp_dir}/plain"
    layout.write_clustered(trips, d, M, partition_col="pickup_date")
    layout.write_plain(trips, p)
    table = spark.read.parquet(d)
    assert dict(table.dtypes)["pickup_date"] == "date"
    a = layout.zone_period_query(table, M, 132, "2023-07-01", "2023-07-31", "pickup_date")
    b = layout.zone_period_query(spark.read.parquet(p), M, 132, "2023-07-01", "2023-07-31", None)
    assert sorted(a.collect()) == sorted(b.collect())
    assert "PartitionFilters: [isnotnull(pickup_date" in plan_text(a)


def test_benchmark_reports_less_data_scanned(spark, trips, tmp_dir):
    c, p = f"{tmp_dir}/clustered", f"{tmp_dir}/plain"
    layout.write_clustered(trips, c, M)
    layout.write_plain(trips, p)
    r = layout.benchmark(spark, c, p, M, 132, "2023-07-01", "2023-07-31").collect()[0]
    assert r.clustered_files == 1 and r.naive_files >= 1
    assert r.clustered_bytes < r.naive_bytes
    assert 0 < r.clustered_bytes_read < r.naive_bytes_read
    assert r.bytes_scanned_reduction_pct == pytest.approx(100 * (1 - r.clustered_bytes_read / r.naive_bytes_read), abs=0.01)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


@pytest.fixture(scope="module")
def year(spark):
    """Trips of 200 zones on 360 days, in no order, with a wide column."""
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(360)).cast("int"))
    return spark.range(0, 60_000, 1, 4).select(
        (F.col("id") * 104_729 % 200 + 1).alias(M.origin), day.alias("pickup_date"),
        F.date_format(day, "yyyy-MM").alias("year_month"), F.lit(1.5).alias(M.distance),
        (F.col("id") % 100).cast("decimal(10,2)").alias(M.total), (F.col("id") % 3).alias(M.payment), F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )


def bytes_of(spark, df):
    with scanlog.job_group(spark, "test") as group:
        rows = df.collect()
    read = scanlog.input_of(spark, [group])[group]
    return len(rows), *read


def test_bytes_read_fall_with_pruned_columns_and_skipped_row_groups(spark, year, tmp_dir):
    path = f"{tmp_dir}/sorted"
    year.coalesce(1).sort(M.origin).write.option("parquet.block.size", 512 * 1024).parquet(path)
    table = spark.read.parquet(path)
    rows, wide, _ = bytes_of(spark, table)
    assert rows == 60_000
    _, narrow, _ = bytes_of(spark, table.select(M.origin))
    found, skipped, records = bytes_of(spark, table.filter(F.col(M.origin) == 7))
    assert found == 300 and records < 30_000  # most row groups are not read
    assert narrow < wide / 3 and skipped < wide / 3


def test_interleaved_layout_skips_on_zone_and_on_date(spark, year, tmp_dir):
    paths = [f"{tmp_dir}/{n}" for n in ("interleaved", "plain", "clustered")]
    layout.write_interleaved(year, paths[0], M, files=4, row_group_bytes=64 * 1024)
    year.write.option("parquet.block.size", 64 * 1024).parquet(paths[1])
    layout.write_clustered(year, paths[2], M)
    tables = [spark.read.parquet(p) for p in paths]
    zone, week = F.col(M.origin) == 77, F.col("pickup_date").between(dt.date(2023, 5, 1), dt.date(2023, 5, 7))
    for condition in (zone, week, zone & week):
        (rows, read, _), (same, all_read, _) = (bytes_of(spark, t.filter(condition)) for t in tables[:2])
        assert rows == same > 0
        assert read < all_read / 2
    a, b, c = (sorted(layout.zone_period_query(t, M, 77, "2023-02-01", "2023-03-31", p).collect()) for t, p in zip(tables, (None, None, "year_month")))
    assert a == b == c and a


def test_interleaved_bits(spark):
    key = layout.interleaved(F.col("x"), F.col("y"), 3)
    rows = spark.createDataFrame([(5, 0), (0, 5), (7, 7), (3, 4)], "x int, y int").select(key.alias("k")).collect()
    assert [r.k for r in rows] == [0b010001, 0b100010, 0b111111, 0b100101]
    empty = spark.createDataFrame([], f"{M.origin} int, pickup_date date")
    layout.write_interleaved(empty, f"{tempfile.mkdtemp(prefix='tripline-test-')}/none", M)


def test_date_range_filter_adds_month_range():
    cond = str(layout.date_range_filter("2023-07-01", "2023-08-15"))
    assert "year_month" in cond and "2023-07" in cond and "2023-08" in cond


@pytest.mark.parametrize(
    "sql",
    ["DROP TABLE x", "select 1; select 2", "UPDATE t SET a = 1", "SHOW TABLES",
     "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
     "SELECT java_method('java.lang.System', 'exit', 1)", "SELECT reflect('java.util.UUID', 'randomUUID')",
     "SELECT * FROM parquet.`/root/testdata/sf0.001/lineitem.parquet`", "SELECT * FROM lineitem",
     "SELECT (SELECT max(x) FROM other) FROM vw_daily_kpis", "nonsense",
     # names of WITH clauses hold where they are in scope only
     "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret",
     "WITH a AS (SELECT 1 AS x), b AS (SELECT * FROM c), c AS (SELECT 2 AS x) SELECT * FROM b",
     "WITH a AS (WITH inner_one AS (SELECT 1 AS x) SELECT * FROM inner_one) SELECT * FROM a JOIN inner_one",
     "SELECT (WITH a AS (SELECT 1 AS y) SELECT max(y) FROM a) FROM a",
     "WITH vw AS (SELECT 1 AS x) SELECT * FROM db.vw",
     "SELECT * FROM vw_daily_kpis WHERE day IN (SELECT day FROM other)",
     "SELECT * FROM vw_daily_kpis ORDER BY (SELECT max(x) FROM other)",
     "SELECT sum(x) OVER w FROM vw_daily_kpis WINDOW w AS (ORDER BY (SELECT max(x) FROM other))",
     "SELECT * FROM VALUES ((SELECT max(x) FROM other)) AS t(x)",
     "SELECT * FROM vw_daily_kpis GROUP BY day HAVING max(trips) > (SELECT 1 FROM other)",
     # lateral subqueries and functions that make rows are refused on purpose
     "SELECT * FROM vw_daily_kpis, LATERAL (SELECT 1)", "SELECT * FROM range(5)",
     "SELECT x FROM vw_daily_kpis LATERAL VIEW json_tuple('{}', 'a') t AS x",
     "SELECT * FROM IDENTIFIER('vw_' || 'x')", "SELECT system.builtin.reflect('a', 'b')"],
)
def test_guard_rejects(spark, sql):
    with pytest.raises(ValueError):
        adhoc.guarded_query(spark, sql, ["vw_daily_kpis"])


def test_guard_accepts_words_in_texts_and_ctes(spark):
    assert adhoc.guarded_query(spark, "SELECT 'load' AS x", []).collect()[0].x == "load"
    assert adhoc.guarded_query(spark, "WITH a AS (SELECT 1 AS x) SELECT * FROM a;", []).count() == 1


def test_guard_reads_names_in_their_scope(spark):
    spark.range(4).createOrReplaceTempView("v_scope")
    spark.range(9).createOrReplaceTempView("secret")
    for sql, rows in [
        ("WITH a AS (SELECT * FROM v_scope), b AS (SELECT * FROM a) SELECT * FROM b WHERE id IN (SELECT id FROM a)", 4),
        ("WITH v_scope AS (SELECT 7 AS id) SELECT * FROM V_SCOPE", 1),  # shadows the view
        ("WITH a AS (WITH a AS (SELECT * FROM v_scope) SELECT * FROM a) SELECT * FROM a", 4),
        ("SELECT id, x FROM v_scope LATERAL VIEW explode(array(1, 2)) t AS x", 8),
        ("SELECT sum(id) OVER w AS s FROM v_scope WINDOW w AS (ORDER BY id)", 4),
    ]:
        assert adhoc.guarded_query(spark, sql, ["v_scope"]).count() == rows
    recursive = "WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 3) SELECT * FROM r"
    assert adhoc.relations_of(spark, recursive) == set()
    with pytest.raises(ValueError, match="scan"):  # no bound on what it scans
        adhoc.guarded_query(spark, recursive, [])
    with pytest.raises(ValueError, match="secret"):
        adhoc.guarded_query(spark, "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret", ["v_scope"])


def test_guard_leaves_literals_alone(spark):
    text = "a\nInsertIntoStatement 'UnresolvedRelation [x]\n+- CTE [y]"
    assert adhoc.guarded_query(spark, f"SELECT '{text.replace(chr(39), chr(34))}' AS x", []).collect()[0].x.startswith("a\n")
    assert adhoc.guarded_query(spark, "SELECT 'a\nb' AS x, \"from secret\" AS y", []).collect()[0].x == "a\nb"


def test_guarded_query_caps_rows(spark):
    spark.range(1000).withColumn("g", F.col("id") % 7).createOrReplaceTempView("t_guard")
    df = adhoc.guarded_query(spark, "SELECT * FROM (SELECT * FROM t_guard LIMIT 500) ORDER BY id;", ["t_guard"])
    assert df.count() == 200
    assert adhoc.estimated_scan_bytes(df) > 0
    with pytest.raises(ValueError):
        adhoc.guarded_query(spark, "SELECT * FROM t_guard", ["t_guard"], max_bytes=1)


def test_scan_estimate_follows_columns_partitions_and_subqueries(spark, tmp_dir):
    path = f"{tmp_dir}/wide"
    wide = spark.range(20_000).selectExpr("id", "sha2(cast(id as string), 512) as note", "id % 4 as part")
    wide.coalesce(1).write.partitionBy("part").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("v_wide")

    def size(sql):
        return adhoc.estimated_scan_bytes(spark.sql(sql))

    total, narrow = size("SELECT * FROM v_wide"), size("SELECT sum(id) FROM v_wide")
    assert 0 < narrow < total / 10
    assert size("SELECT * FROM v_wide WHERE part = 2") == pytest.approx(total / 4, rel=0.05)
    assert size("SELECT * FROM v_wide WHERE id > (SELECT avg(id) FROM v_wide)") == total + narrow
    assert size("SELECT 1") < 100
    cap = total // 2
    assert adhoc.guarded_query(spark, "SELECT max(id) FROM v_wide", ["v_wide"], max_bytes=cap).count() == 1
    with pytest.raises(ValueError, match="scan"):
        adhoc.guarded_query(spark, "SELECT max(note) FROM v_wide", ["v_wide"], max_bytes=cap)
    with pytest.raises(ValueError, match="scan"):
        adhoc.guarded_query(spark, "SELECT * FROM v_wide", ["v_wide"], max_bytes=cap)
    assert adhoc.guarded_query(spark, "SELECT * FROM v_wide WHERE part = 1", ["v_wide"], max_bytes=cap).count() == 200
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_referenced_views(spark):
    sql = "SELECT * FROM vw_daily_kpis d JOIN VW_MONTHLY_TREND m ON true"
    assert adhoc.relations_of(spark, sql) == {"vw_daily_kpis", "vw_monthly_trend"}
