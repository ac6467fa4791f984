"""Views, report tables, dashboard queries (FIXTURES.md §4 cases)."""

import datetime as dt
from decimal import Decimal

from tripline.operators import report
from tripline.plans import views

DAILY_DDL = (
    "pickup_date date, PULocationID bigint, pickup_borough string, pickup_zone string, "
    "trip_count bigint, total_revenue decimal(28,4), avg_fare double, avg_distance double, "
    "avg_duration_min double, avg_revenue_per_mile double"
)


def daily(spark, rows):
    full = [
        (d, z, b, zn, n, Decimal(rev), 10.0, 2.0, 15.0, 5.0) for (d, z, b, zn, n, rev) in rows
    ]
    return spark.createDataFrame(full, DAILY_DDL)


def test_monthly_growth(spark):
    rows = [
        (dt.date(2023, m, 1), 1, "Q", "A", 10, rev)
        for m, rev in zip((1, 2, 3, 4), (100, 150, 0, 50))
    ]
    out = views.monthly_trend(daily(spark, rows)).orderBy("month").collect()
    assert [r.revenue_mom_pct for r in out] == [None, 50.0, -100.0, None]
    assert [r.trips_mom_pct for r in out] == [None, 0.0, 0.0, 0.0]


def test_rank_ties_view_vs_report(spark):
    d = dt.date(2023, 1, 1)
    rows = [(d, 1, "Q", "A", 1, 9), (d, 2, "Q", "B", 1, 9), (d, 3, "Q", "C", 1, 5)]
    board = views.zone_leaderboard(daily(spark, rows)).orderBy("pickup_zone").collect()
    assert [r.revenue_rank for r in board] == [1, 1, 3]
    top = report.zone_top(daily(spark, rows)).orderBy("rank").collect()
    assert [r["rank"] for r in top] == [1, 2, 3]
    assert [r.pickup_zone for r in top] == ["A", "B", "C"]


def test_sunday_weeks_and_cohort_offset(spark):
    rows = [
        (dt.date(2023, 1, 7), 1, "Q", "A", 1, 10),  # Saturday
        (dt.date(2023, 1, 8), 1, "Q", "A", 1, 20),  # Sunday
    ]
    out = views.zone_weekly_cohort(daily(spark, rows)).orderBy("weeks_since_first").collect()
    assert [str(r.cohort_week) for r in out] == ["2023-01-01", "2023-01-01"]
    assert [r.weeks_since_first for r in out] == [0, 1]
    assert [float(r.revenue) for r in out] == [10.0, 20.0]


def test_daily_kpis_unweighted_average(spark):
    d = dt.date(2023, 1, 1)
    df = spark.createDataFrame(
        [(d, 1, "Q", "A", 1, Decimal(10), 10.0, 1.0, 10.0, 1.0), (d, 2, "Q", "B", 3, Decimal(30), 10.0, 3.0, 20.0, 1.0)],
        DAILY_DDL,
    )
    r = views.daily_kpis(df).collect()[0]
    assert r.trips == 4 and float(r.revenue) == 40.0 and r.revenue_per_trip == 10.0
    assert r.avg_distance == 2.0  # average of the zone averages, not trip-weighted
    assert r.avg_duration_min == 15.0


def test_borough_share_sums_to_100(spark):
    d = dt.date(2023, 1, 1)
    rows = [(d, 1, "Q", "A", 1, 30), (d, 2, "M", "B", 1, 70), (d, 3, None, None, 1, 50)]
    out = {r.borough: r.revenue_share_pct for r in views.borough_share(daily(spark, rows)).collect()}
    assert out == {"Q": 30.0, "M": 70.0}


def test_hourly_matrix_fills_all_weekdays(spark):
    hourly = spark.createDataFrame(
        [(8, "Mon", "Q", 5, 1.0, 1.0, 1.0), (8, "Mon", "M", 2, 1.0, 1.0, 1.0), (9, "Sun", "Q", 1, 1.0, 1.0, 1.0)],
        "pickup_hour int, pickup_dow string, pickup_borough string, trip_count bigint, "
        "avg_fare double, avg_duration_min double, avg_speed_mph double",
    )
    out = {r.hour: r for r in report.hourly_matrix(hourly).collect()}
    assert out[8].Mon == 7 and out[8].Sun == 0 and out[9].Sun == 1
    assert report.hourly_matrix(hourly).columns == ["hour", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def test_dashboard_top_zones_is_deterministic(spark):
    d = dt.date(2023, 1, 1)
    rows = [(d, i, "Q", f"Z{i:02d}", 1, 5) for i in range(20)]
    top = views.dash_top_zones(views.zone_leaderboard(daily(spark, rows))).collect()
    assert [r.pickup_zone for r in top] == [f"Z{i:02d}" for i in range(15)]
