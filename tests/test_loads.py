"""Ledger loads, mergeable partials and bitmaps on hand-made trips."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import taxi_frame, taxi_row, zone_frame
from tripline.functions import sunday_week
from tripline.model import TAXI_MODEL as M
from tripline.operators import aggregates, enrich, partials
from tripline.plans import loads, views
from tripline.sources import files


def trips_of(spark, months, n=12, fare=7.25):
    rows = []
    for month in months:
        for i in range(n):
            at = dt.datetime(2023, month, 1 + i % 28, i % 24, 10)
            rows.append(taxi_row(
                tpep_pickup_datetime=at, tpep_dropoff_datetime=at + dt.timedelta(minutes=20 + i),
                PULocationID=(132, 236, 1, 999)[(i + month) % 4], fare_amount=fare + i / 3, total_amount=10.0 + i / 7,
            ))
    return enrich.enrich(taxi_frame(spark, rows), zone_frame(spark), M)


@pytest.fixture()
def places(tmp_dir):
    return f"{tmp_dir}/source", f"{tmp_dir}/table", f"{tmp_dir}/ledger"


def put(df, source):
    files.write_partitioned(df, source, "year_month", only_partitions=True)


def load(spark, places, **options):
    found = loads.load_partitions(spark, *places, "year_month", **options).collect()
    return {r.year_month: (r.files, r.rows) for r in found}


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_second_load_changes_nothing(spark, places):
    put(trips_of(spark, (1, 2)), places[0])
    assert load(spark, places) == {"2023-01": (1, 12), "2023-02": (1, 12)}
    before = {d: sorted(os.listdir(f"{places[1]}/{d}")) for d in os.listdir(places[1]) if "=" in d}
    assert load(spark, places) == {}
    assert {d: sorted(os.listdir(f"{places[1]}/{d}")) for d in os.listdir(places[1]) if "=" in d} == before


def test_new_changed_and_vanished_months(spark, places):
    put(trips_of(spark, (1, 2, 3)), places[0])
    load(spark, places)
    january = sorted(os.listdir(f"{places[1]}/year_month=2023-01"))
    put(trips_of(spark, (2,), n=5), places[0])  # a corrected file
    put(trips_of(spark, (4,)), places[0])  # a new month
    loads._drop_partitions(spark, places[0], "year_month", ["2023-03"])
    assert load(spark, places) == {"2023-02": (1, 5), "2023-03": (0, 0), "2023-04": (1, 12)}
    table = files.read_partitioned(spark, places[1], "year_month")
    assert rows_of(table) == rows_of(files.read_partitioned(spark, places[0], "year_month"))
    assert sorted(os.listdir(f"{places[1]}/year_month=2023-01")) == january  # never touched
    assert load(spark, places) == {}


def test_a_load_that_died_before_its_ledger_is_done_again(spark, places):
    put(trips_of(spark, (1, 2)), places[0])
    load(spark, (places[0], places[1], places[2] + "-lost"))
    assert loads.rows_loaded(loads.load_partitions(spark, *places, "year_month")) == 24
    assert files.read_partitioned(spark, places[1], "year_month").count() == 24


@pytest.mark.parametrize("kind", ["daily", "hourly"])
def test_partials_read_the_new_month_only_and_merge_to_the_aggregate(spark, places, kind):
    seen = []

    def transform(rows):
        seen.append(sorted(r[0] for r in rows.select("year_month").distinct().collect()))
        return partials.daily_partials(rows, M) if kind == "daily" else partials.hourly_partials(rows, M.fare)

    trips = trips_of(spark, (1, 2, 3, 4))
    for months in (["2023-01", "2023-02"], ["2023-03"], ["2023-04"]):
        put(trips.filter(F.col("year_month").isin(months)), places[0])
        assert sorted(load(spark, places, transform=transform)) == months
    assert seen == [["2023-01", "2023-02"], ["2023-03"], ["2023-04"]]
    stored = files.read_partitioned(spark, places[1], "year_month")
    merged = partials.merge_daily(stored, M) if kind == "daily" else partials.merge_hourly(stored, M.fare)
    whole = aggregates.daily_zone(trips, M) if kind == "daily" else aggregates.hourly_profile(trips, M.fare)
    assert rows_of(merged) == rows_of(whole)


def test_partials_keep_amounts_that_no_decimal_holds(spark):
    rows = [taxi_row(fare_amount=f, total_amount=1e-13 * i) for i, f in enumerate((1e30, 0.1, None, 2.5, -1e30))]
    trips = enrich.enrich(taxi_frame(spark, rows), zone_frame(spark), M)
    assert rows_of(partials.merge_daily(partials.daily_partials(trips, M), M)) == rows_of(aggregates.daily_zone(trips, M))


def test_bitmaps_of_months_count_distinct_zones(spark):
    trips = trips_of(spark, (1, 2, 3), n=28)
    exact = trips.filter("pickup_zone IS NOT NULL").groupBy(sunday_week("pickup_date").alias("week")).agg(
        F.count_distinct("pickup_zone").alias("active_zones")
    )
    bitmaps = partials.zone_week_bitmaps(trips, M)
    assert bitmaps.groupBy("week").count().filter("count > 1").count() > 0  # weeks with days of two months
    assert rows_of(partials.active_zones(bitmaps)) == rows_of(exact)
    daily = aggregates.daily_zone(trips, M)
    merged = partials.merge_cohorts(partials.cohort_bitmaps(daily, M))
    assert rows_of(merged) == rows_of(views.zone_weekly_cohort(daily))
    assert "Expand" not in merged._jdf.queryExecution().toString()
