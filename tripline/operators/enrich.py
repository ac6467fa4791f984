"""Role-playing dimension joins and derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions import weekday_name
from tripline.model import TripModel
from tripline.operators.clean import duration_seconds


def attach_zones(trips: DataFrame, zones: DataFrame, model: TripModel) -> DataFrame:
    """LEFT join the zone dimension twice: pickup role and dropoff role.

    ``zones`` is ``(zone_id, zone, borough)``.  The joins carry no hint: Spark
    broadcasts the zones when their bytes are below its threshold."""
    pickup = zones.select(
        F.col("zone_id").alias(model.origin),
        F.col("borough").alias("pickup_borough"),
        F.col("zone").alias("pickup_zone"),
    )
    dropoff = zones.select(
        F.col("zone_id").alias(model.dest),
        F.col("borough").alias("dropoff_borough"),
        F.col("zone").alias("dropoff_zone"),
    )
    return trips.join(pickup, model.origin, "left").join(dropoff, model.dest, "left")


def _metric_columns(model: TripModel) -> dict:
    minutes = duration_seconds(model) / 60.0
    return {
        "trip_duration_min": minutes,
        "avg_speed_mph": F.round(F.try_divide(F.col(model.distance), minutes / 60.0), 2),
        "revenue_per_mile": F.round(F.try_divide(F.col(model.total), F.col(model.distance)), 2),
    }


def _calendar_columns(model: TripModel) -> dict:
    start = F.col(model.start)
    return {
        "pickup_date": F.to_date(start),
        "pickup_hour": F.hour(start),
        "pickup_dow": weekday_name(start),
        "year_month": F.date_format(start, "yyyy-MM"),
    }


def derive_metrics(trips: DataFrame, model: TripModel) -> DataFrame:
    """trip_duration_min (unrounded), avg_speed_mph and revenue_per_mile
    (rounded to 2, NULL instead of a division by zero)."""
    return trips.withColumns(_metric_columns(model))


def derive_calendar(trips: DataFrame, model: TripModel) -> DataFrame:
    return trips.withColumns(_calendar_columns(model))


def enrich(trips: DataFrame, zones: DataFrame, model: TripModel) -> DataFrame:
    # metrics and calendar columns in one projection
    return attach_zones(trips, zones, model).withColumns(
        {**_metric_columns(model), **_calendar_columns(model)}
    )
