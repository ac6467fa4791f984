"""Cleaning rules, reject profile, dedupe, derivations (taxi binding)."""

import pytest

from tests.helpers import plan_text, taxi_frame, taxi_row, ts, zone_frame
from tripline.model import TAXI_MODEL as M
from tripline.operators import clean, enrich


def kept(spark, *rows):
    return clean.clean(taxi_frame(spark, list(rows)), M).count()


def test_valid_row_is_kept(spark):
    assert kept(spark, taxi_row()) == 1


def test_nan_total_is_rejected(spark):
    assert kept(spark, taxi_row(total_amount=float("nan"))) == 0


def test_infinite_amounts_are_rejected(spark):
    inf = float("inf")
    assert kept(spark, taxi_row(total_amount=inf), taxi_row(fare_amount=inf), taxi_row(trip_distance=inf),
                taxi_row(passenger_count=inf)) == 0


def test_null_passenger_count_is_rejected(spark):
    assert kept(spark, taxi_row(passenger_count=None)) == 0


@pytest.mark.parametrize(
    "kw,expected",
    [
        ({"tpep_dropoff_datetime": ts("2023-03-01 14:00:00")}, 1),  # exactly 6 h
        ({"tpep_dropoff_datetime": ts("2023-03-01 14:00:01")}, 0),
        ({"trip_distance": 200.0}, 1),
        ({"trip_distance": 200.01}, 0),
        ({"fare_amount": 1000.0}, 1),
        ({"fare_amount": 1000.01}, 0),
        ({"PULocationID": 263}, 1),
        ({"PULocationID": 264}, 0),
        ({"DOLocationID": 0}, 0),
        ({"tpep_pickup_datetime": ts("2022-12-31 23:50:00")}, 0),  # wrong year
        ({"tpep_dropoff_datetime": ts("2023-03-01 08:00:00")}, 0),  # not after pickup
    ],
)
def test_cleaning_edges(spark, kw, expected):
    assert kept(spark, taxi_row(**kw)) == expected


def test_zero_second_trip(spark):
    row = taxi_row(
        tpep_pickup_datetime=ts("2023-03-01 00:00:00.100000"),
        tpep_dropoff_datetime=ts("2023-03-01 00:00:00.900000"),
    )
    df = clean.clean(taxi_frame(spark, [row]), M)
    out = enrich.derive_metrics(df, M).collect()
    assert len(out) == 1
    assert out[0].trip_duration_min == 0.0
    assert out[0].avg_speed_mph is None


def test_reject_profile_counts_each_rule(spark):
    rows = [
        taxi_row(),
        taxi_row(fare_amount=-1.0),
        taxi_row(fare_amount=None, PULocationID=999),
        taxi_row(passenger_count=0.0),
    ]
    found = clean.reject_profile(taxi_frame(spark, rows), M).collect()
    prof, missing = {r.rule: r.rejected for r in found}, {r.rule: r.missing for r in found}
    assert (missing["fare"], missing["party"], missing["any_rule"], missing["rows_in"]) == (1, 0, 1, 0)
    assert prof["rows_in"] == 4
    assert prof["fare"] == 2
    assert prof["origin"] == 1
    assert prof["party"] == 1
    assert prof["any_rule"] == 3
    assert prof["order"] == 0


def test_raw_counts_one_pass(spark):
    rows = [taxi_row(), taxi_row(fare_amount=-1.0)]
    r = clean.raw_counts(taxi_frame(spark, rows), M).collect()[0]
    assert (r.raw_rows_read, r.valid_rows) == (2, 1)


def test_dedupe_whole_row_with_nulls(spark):
    rows = [taxi_row(airport_fee=None)] * 3 + [taxi_row(tip_amount=1.0)]
    assert clean.dedupe(taxi_frame(spark, rows)).count() == 2


def test_enrich_roles_and_calendar(spark):
    df = taxi_frame(spark, [taxi_row(), taxi_row(PULocationID=7)])
    out = enrich.enrich(df, zone_frame(spark), M).orderBy("PULocationID").collect()
    unknown, jfk = out
    assert unknown.pickup_zone is None and unknown.dropoff_borough == "Manhattan"
    assert jfk.pickup_zone == "JFK Airport" and jfk.pickup_borough == "Queens"
    assert jfk.trip_duration_min == 20.0
    assert jfk.avg_speed_mph == 9.0
    assert jfk.revenue_per_mile == pytest.approx(8.33)
    assert (jfk.pickup_hour, jfk.pickup_dow, jfk.year_month) == (8, "Wed", "2023-03")
    assert str(jfk.pickup_date) == "2023-03-01"


def test_filter_reaches_parquet_scan(spark, tmp_dir):
    taxi_frame(spark, [taxi_row()]).write.parquet(f"{tmp_dir}/t")
    df = clean.clean(spark.read.parquet(f"{tmp_dir}/t"), M)
    plan = plan_text(df)
    assert "PushedFilters: [" in plan and "LessThanOrEqual(trip_distance,200.0)" in plan
    assert "ReadSchema" in plan
