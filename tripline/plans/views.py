"""The eight analysis views and the dashboard queries over them.

Each view is a function of the stored aggregates; ``register_views`` makes
them temp views, and Catalyst inlines a view's plan into any query over it.
Windows without PARTITION BY only ever run on already-aggregated rows
(months, zones), never on trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripline.functions import avg_of_doubles, month_start, pct_change, sunday_week

VIEW_NAMES = (
    "vw_daily_kpis",
    "vw_monthly_trend",
    "vw_zone_leaderboard",
    "vw_borough_share",
    "vw_hourly_demand",
    "vw_anomaly_overlay",
    "vw_zone_weekly_cohort",
    "vw_data_quality",
)


def daily_kpis(daily: DataFrame) -> DataFrame:
    rev = F.sum("total_revenue")
    trips = F.sum("trip_count")
    return daily.groupBy(F.col("pickup_date").alias("day")).agg(
        trips.alias("trips"),
        F.round(rev, 2).alias("revenue"),
        F.round(F.try_divide(rev.cast("double"), trips.cast("double")), 2).alias("revenue_per_trip"),
        F.round(avg_of_doubles("avg_distance"), 3).alias("avg_distance"),
        F.round(avg_of_doubles("avg_duration_min"), 2).alias("avg_duration_min"),
    )


def monthly_trend(daily: DataFrame) -> DataFrame:
    """Revenue is rounded before LAG, as in the view definition."""
    monthly = daily.groupBy(month_start("pickup_date").alias("month")).agg(
        F.sum("trip_count").alias("trips"),
        F.round(F.sum("total_revenue"), 2).alias("revenue"),
    )
    w = Window.orderBy("month")  # one row per month: a tiny single partition
    return monthly.select(
        "month",
        "trips",
        "revenue",
        F.round(pct_change(F.col("revenue"), F.lag("revenue").over(w)), 2).alias("revenue_mom_pct"),
        F.round(pct_change(F.col("trips"), F.lag("trips").over(w)), 2).alias("trips_mom_pct"),
    )


def zone_leaderboard(daily: DataFrame) -> DataFrame:
    """Rank by the unrounded revenue; ties share a rank, then a gap."""
    by_zone = (
        daily.filter(F.col("pickup_zone").isNotNull())
        .groupBy("pickup_zone", "pickup_borough")
        .agg(
            F.sum("trip_count").alias("trips"),
            F.sum("total_revenue").alias("_revenue"),
            F.round(avg_of_doubles("avg_revenue_per_mile"), 2).alias("avg_revenue_per_mile"),
        )
    )
    w = Window.orderBy(F.col("_revenue").desc())  # one row per zone
    return by_zone.select(
        "pickup_zone",
        "pickup_borough",
        "trips",
        F.round("_revenue", 2).alias("revenue"),
        "avg_revenue_per_mile",
        F.rank().over(w).alias("revenue_rank"),
    )


def borough_share(daily: DataFrame) -> DataFrame:
    by_month = (
        daily.filter(F.col("pickup_borough").isNotNull())
        .groupBy(month_start("pickup_date").alias("month"), F.col("pickup_borough").alias("borough"))
        .agg(F.sum("total_revenue").alias("_revenue"))
    )
    month_total = F.sum("_revenue").over(Window.partitionBy("month"))
    share = F.try_divide(F.col("_revenue").cast("double"), month_total.cast("double")) * 100.0
    return by_month.select(
        "month",
        "borough",
        F.round("_revenue", 2).alias("revenue"),
        F.round(share, 2).alias("revenue_share_pct"),
    )


def hourly_demand(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_dow", "pickup_hour").agg(
        F.sum("trip_count").alias("trips"),
        F.round(avg_of_doubles("avg_fare"), 2).alias("avg_fare"),
        F.round(avg_of_doubles("avg_speed_mph"), 2).alias("avg_speed_mph"),
    )


def anomaly_overlay(flags: DataFrame) -> DataFrame:
    return flags.select(
        F.col("pickup_date").alias("day"),
        "grain_type",
        "grain",
        "metric",
        "value",
        "rolling_mean",
        "z_score",
        "is_anomalous",
    )


def zone_weekly_cohort(daily: DataFrame) -> DataFrame:
    """Weeks start on Sunday.  The first active week per zone comes from a
    window partitioned by zone over the (zone, week) rows — no self-join,
    one read of the weekly rows."""
    weekly = (
        daily.filter(F.col("pickup_zone").isNotNull())
        .groupBy("pickup_zone", sunday_week("pickup_date").alias("week"))
        .agg(F.sum("total_revenue").alias("revenue"))
    )
    with_cohort = weekly.withColumn(
        "cohort_week", F.min("week").over(Window.partitionBy("pickup_zone"))
    )
    weeks_since = (F.datediff("week", "cohort_week") / 7).cast("bigint")
    return with_cohort.groupBy("cohort_week", weeks_since.alias("weeks_since_first")).agg(
        F.count_distinct("pickup_zone").alias("active_zones"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
    )


def data_quality(checks: DataFrame) -> DataFrame:
    return checks.select("name", "severity", "passed", "detail")


def stored_frames(daily: DataFrame, hourly: DataFrame, flags: DataFrame,
                  checks: DataFrame) -> dict[str, DataFrame]:
    """The eight views over stored tables (the ETL outputs)."""
    return {
        "vw_daily_kpis": daily_kpis(daily),
        "vw_monthly_trend": monthly_trend(daily),
        "vw_zone_leaderboard": zone_leaderboard(daily),
        "vw_borough_share": borough_share(daily),
        "vw_hourly_demand": hourly_demand(hourly),
        "vw_anomaly_overlay": anomaly_overlay(flags),
        "vw_zone_weekly_cohort": zone_weekly_cohort(daily),
        "vw_data_quality": data_quality(checks),
    }


def register_stored(daily: DataFrame, hourly: DataFrame, flags: DataFrame,
                    checks: DataFrame) -> list[str]:
    """Create the eight temp views over stored tables."""
    frames = stored_frames(daily, hourly, flags, checks)
    for name, df in frames.items():
        ordered(name, df).createOrReplaceTempView(name)
    return list(frames)


def ordered(view_name: str, df: DataFrame) -> DataFrame:
    """The ORDER BY each view declares (applied on results only)."""
    orders = {
        "vw_monthly_trend": ["month"],
        "vw_zone_leaderboard": [F.col("revenue").desc()],
        "vw_borough_share": ["month", F.col("revenue").desc()],
        "vw_hourly_demand": ["pickup_dow", "pickup_hour"],
        "vw_anomaly_overlay": ["day", "grain", "metric"],
        "vw_zone_weekly_cohort": ["cohort_week", "weeks_since_first"],
        "vw_data_quality": [F.col("passed").asc(), F.col("severity").desc(), "name"],
    }
    keys = orders.get(view_name)
    return df.orderBy(*keys) if keys else df


# --- dashboard queries --------------------------------------------------------


def dash_totals(kpis: DataFrame) -> DataFrame:
    trips, revenue = F.sum("trips"), F.sum("revenue")
    return kpis.agg(
        trips.alias("trips"),
        revenue.alias("revenue"),
        F.try_divide(revenue.cast("double"), trips.cast("double")).alias("rpt"),
    )


def dash_failing_checks(dq: DataFrame) -> DataFrame:
    return dq.agg(
        F.count_if(~F.col("passed") & (F.col("severity") == "error")).alias("failing")
    )


def dash_daily_series(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        F.col("day").cast("timestamp_ntz").alias("time"), "revenue", "trips"
    ).orderBy("time")


def dash_monthly(trend: DataFrame) -> DataFrame:
    return trend.orderBy("month").select(
        F.date_format("month", "yyyy-MM").alias("month"), "revenue", "revenue_mom_pct"
    )


def dash_top_zones(board: DataFrame, n: int = 15) -> DataFrame:
    return board.orderBy("revenue_rank", "pickup_zone", "pickup_borough").limit(n).select(
        "revenue_rank", "pickup_zone", "pickup_borough", "trips", "revenue", "avg_revenue_per_mile"
    )


def dash_heatmap(demand: DataFrame) -> DataFrame:
    return demand.select("pickup_dow", "pickup_hour", "trips").orderBy("pickup_dow", "pickup_hour")


def dash_anomaly_overlay(overlay: DataFrame) -> DataFrame:
    return (
        overlay.filter((F.col("grain_type") == "citywide") & (F.col("metric") == "trip_count"))
        .select(
            F.col("day").cast("timestamp_ntz").alias("time"),
            F.col("value").alias("trips"),
            F.when(F.col("is_anomalous"), F.col("value")).alias("anomaly"),
        )
        .orderBy("time")
    )
