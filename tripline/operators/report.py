"""Report tables (the workbook's data; styling is not built)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripline.functions import WEEKDAYS, avg_of_doubles, month_start, pct_change

TOP_ZONES = 25
AVG_DECIMALS = 6  # unrounded averages are emitted at 6 decimals


def daily(daily_zone: DataFrame) -> DataFrame:
    """Per day: revenue and averages unrounded, revenue per trip rounded."""
    trips, rev = F.sum("trip_count"), F.sum("total_revenue")
    return daily_zone.groupBy("pickup_date").agg(
        trips.alias("trips"),
        rev.cast("double").alias("revenue"),
        F.round(F.try_divide(rev.cast("double"), trips.cast("double")), 2).alias("revenue_per_trip"),
        F.round(avg_of_doubles("avg_distance"), AVG_DECIMALS).alias("avg_distance"),
        F.round(avg_of_doubles("avg_duration_min"), AVG_DECIMALS).alias("avg_duration_min"),
    )


def monthly(daily_zone: DataFrame) -> DataFrame:
    """Month totals from unrounded revenue, growth vs the previous month."""
    m = daily_zone.groupBy(month_start("pickup_date").alias("month")).agg(
        F.sum("trip_count").alias("trips"), F.sum("total_revenue").alias("_revenue")
    )
    w = Window.orderBy("month")  # one row per month
    return m.select(
        "month",
        "trips",
        F.col("_revenue").cast("double").alias("revenue"),
        F.round(pct_change(F.col("_revenue"), F.lag("_revenue").over(w)), 2).alias("revenue_mom_pct"),
        F.round(pct_change(F.col("trips"), F.lag("trips").over(w)), 2).alias("trips_mom_pct"),
    )


def zone_top(daily_zone: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """Top zones by revenue with a gap-free rank (ties broken by name)."""
    z = (
        daily_zone.filter(F.col("pickup_zone").isNotNull() & F.col("pickup_borough").isNotNull())
        .groupBy("pickup_zone", "pickup_borough")
        .agg(
            F.sum("trip_count").alias("trips"),
            F.sum("total_revenue").alias("_revenue"),
            F.round(avg_of_doubles("avg_revenue_per_mile"), 2).alias("avg_revenue_per_mile"),
        )
    )
    order = [F.col("_revenue").desc(), "pickup_zone", "pickup_borough"]
    top = z.orderBy(*order).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "pickup_zone",
        "pickup_borough",
        "trips",
        F.col("_revenue").cast("double").alias("revenue"),
        "avg_revenue_per_mile",
    )


def hourly_matrix(hourly: DataFrame) -> DataFrame:
    """hour x weekday trip counts, Mon..Sun columns, zeros filled."""
    return (
        hourly.groupBy(F.col("pickup_hour").alias("hour"))
        .pivot("pickup_dow", list(WEEKDAYS))
        .agg(F.sum("trip_count"))
        .na.fill(0, list(WEEKDAYS))
    )


def flagged(scored: DataFrame) -> DataFrame:
    """Flagged anomalies, largest |z| first, values rounded to 2."""
    return (
        scored.filter("is_anomalous")
        .orderBy(F.abs("z_score").desc(), "pickup_date", "grain", "metric")
        .select(
            F.col("pickup_date").alias("date"),
            "grain",
            "metric",
            F.round("value", 2).alias("value"),
            F.round("rolling_mean", 2).alias("rolling_mean"),
            F.round("z_score", 2).alias("z_score"),
            "is_anomalous",
        )
    )


def summary(
    daily_zone: DataFrame,
    stage_counts: DataFrame,
    checks: DataFrame,
    scored: DataFrame,
    origin: str,
    layout_report: DataFrame | None = None,
) -> DataFrame:
    """Headline numbers as one row.  Each input contributes a one-row
    aggregate; they are combined by union + one global aggregate (no join).
    The layout benchmark's reduction and speed-up are NULL without a report."""
    totals = daily_zone.agg(
        F.min("pickup_date").alias("date_from"),
        F.max("pickup_date").alias("date_to"),
        F.sum("trip_count").alias("total_trips"),
        F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.count_distinct(origin).alias("distinct_pickup_zones"),
    )
    bag_cols = {
        "date_from": "date", "date_to": "date", "total_trips": "bigint",
        "total_revenue": "double", "distinct_pickup_zones": "bigint",
        "raw_rows_read": "bigint", "final_cleaned_rows": "bigint",
        "invalid_rows_dropped": "bigint", "duplicate_rows_dropped": "bigint",
        "checks_passed": "bigint", "checks_total": "bigint", "anomalies_flagged": "bigint",
        "bytes_scanned_reduction_pct": "double", "wall_clock_speedup_x": "double",
    }

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in bag_cols.items()]
        )

    steps = stage_counts.agg(
        *[
            F.max(F.when(F.col("name") == k, F.col("value"))).alias(k)
            for k in ("raw_rows_read", "final_cleaned_rows", "invalid_rows_dropped",
                      "duplicate_rows_dropped")
        ]
    )
    dq = checks.agg(
        F.count_if("passed").alias("checks_passed"), F.count(F.lit(1)).alias("checks_total")
    )
    an = scored.agg(F.count_if("is_anomalous").alias("anomalies_flagged"))
    bag = shaped(totals).unionByName(shaped(steps)).unionByName(shaped(dq)).unionByName(shaped(an))
    if layout_report is not None:
        bag = bag.unionByName(shaped(layout_report))
    row = bag.agg(*[F.max(c).alias(c) for c in bag_cols])
    trips, rev = F.col("total_trips"), F.col("total_revenue")
    raw = F.col("raw_rows_read")
    return row.select(
        *[c for c in bag_cols if c not in ("bytes_scanned_reduction_pct", "wall_clock_speedup_x")],
        F.when(trips > 0, rev / trips.cast("double")).otherwise(F.lit(0.0)).alias("avg_revenue_per_trip"),
        F.when(raw > 0, F.col("final_cleaned_rows") * 100.0 / raw.cast("double")).alias("clean_rate_pct"),
        "bytes_scanned_reduction_pct",
        "wall_clock_speedup_x",
    )
