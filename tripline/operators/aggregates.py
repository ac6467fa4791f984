"""Trip aggregates: daily x origin zone, hour x weekday x borough, and the
city-wide + per-borough daily series (one GROUPING SETS pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions import exact_avg, exact_sum, minutes_avg
from tripline.model import TripModel

CITYWIDE = "citywide"


def daily_zone(trips: DataFrame, model: TripModel) -> DataFrame:
    """``(pickup_date, origin, pickup_borough, pickup_zone)`` -> six measures.
    Partial + final hash aggregate; NULL boroughs/zones stay as groups."""
    return trips.groupBy("pickup_date", model.origin, "pickup_borough", "pickup_zone").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum(trips, model.total).alias("total_revenue"),
        exact_avg(trips, model.fare).alias("avg_fare"),
        exact_avg(trips, model.distance).alias("avg_distance"),
        minutes_avg("trip_duration_min").alias("avg_duration_min"),
        exact_avg(trips, "revenue_per_mile").alias("avg_revenue_per_mile"),
    )


def hourly_profile(trips: DataFrame, fare: str) -> DataFrame:
    """``(pickup_hour, pickup_dow, pickup_borough)`` -> count and averages."""
    return trips.groupBy("pickup_hour", "pickup_dow", "pickup_borough").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_avg(trips, fare).alias("avg_fare"),
        minutes_avg("trip_duration_min").alias("avg_duration_min"),
        exact_avg(trips, "avg_speed_mph").alias("avg_speed_mph"),
    )


def citywide_and_borough(daily: DataFrame) -> DataFrame:
    """Daily totals city-wide and per borough as one long series.

    GROUPING SETS ((date), (date, borough)); ``grouping()`` tells the
    city-wide total from a NULL-borough group.  NULL boroughs are left out
    of the borough grain only (they still count city-wide)."""
    sets = daily.groupingSets(
        [["pickup_date"], ["pickup_date", "pickup_borough"]], "pickup_date", "pickup_borough"
    ).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("total_revenue").alias("total_revenue"),
        F.grouping("pickup_borough").alias("_total_row"),
    )
    is_total = F.col("_total_row") == 1
    return sets.filter(is_total | F.col("pickup_borough").isNotNull()).select(
        "pickup_date",
        F.when(is_total, F.lit(CITYWIDE)).otherwise(F.lit("borough")).alias("grain_type"),
        F.when(is_total, F.lit(CITYWIDE)).otherwise(F.col("pickup_borough")).alias("grain"),
        "trip_count",
        "total_revenue",
    )
