"""Trip aggregates as stored, mergeable partials.

A partial keeps what sums of sums need: the exact part of an amount's sum, the
double part of what no DECIMAL holds, and the count.  Partials of months (or
of any other split of the rows) merge by adding, and only then an average is
divided, so merged results equal those of one pass over all trips.

Distinct zones are kept as bitmaps, one bit for each zone id: bitmaps of
months merge by OR, and a count of bits is a count of distinct zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from tripline.functions import EXACT, held_exactly, sunday_week
from tripline.model import TripModel

MONTH = "year_month"


def amount_parts(df: DataFrame, name: str) -> list[Column]:
    """``<name>_exact``, ``<name>_rest``, ``<name>_n`` over an amount."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DecimalType, IntegralType)):
        exact, rest = F.sum(c), F.sum(F.lit(None).cast("double"))
    else:
        c = c.cast("double")
        held = held_exactly(c, EXACT)
        exact, rest = F.sum(F.when(held, c.try_cast(EXACT))), F.sum(F.when(~held, c))
    return [exact.alias(f"{name}_exact"), rest.alias(f"{name}_rest"), F.count(c).alias(f"{name}_n")]


def minute_parts(name: str) -> list[Column]:
    """Whole seconds and count of a duration in minutes."""
    seconds = F.round(F.col(name) * 60.0).cast("bigint")
    return [F.sum(seconds).alias(f"{name}_seconds"), F.count(name).alias(f"{name}_n")]


def merged_sum(partials: DataFrame, name: str) -> Column:
    """SUM of an amount over partials: in its own type when that is DECIMAL or integer, a double for others."""
    exact, rest, n = F.sum(f"{name}_exact"), F.sum(f"{name}_rest"), F.sum(f"{name}_n")
    if isinstance(partials.schema[f"{name}_exact"].dataType, DecimalType) and partials.schema[f"{name}_exact"].dataType.scale == EXACT.scale:
        return F.when(n > 0, F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)))
    return exact


def merged_avg(partials: DataFrame, name: str) -> Column:
    return F.try_divide(merged_sum(partials, name).cast("double"), F.sum(f"{name}_n").cast("double"))


def merged_minutes(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_seconds").cast("double"), F.sum(f"{name}_n") * 60.0)


def daily_partials(trips: DataFrame, model: TripModel) -> DataFrame:
    """Partials of the daily aggregate, by month."""
    amounts = [p for a in (model.total, model.fare, model.distance, "revenue_per_mile") for p in amount_parts(trips, a)]
    keys = (MONTH, "pickup_date", model.origin, "pickup_borough", "pickup_zone")
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), *amounts, *minute_parts("trip_duration_min"))


def merge_daily(partials: DataFrame, model: TripModel) -> DataFrame:
    """``aggregates.daily_zone`` of all trips that went into the partials."""
    return partials.groupBy("pickup_date", model.origin, "pickup_borough", "pickup_zone").agg(
        F.sum("trip_count").alias("trip_count"),
        merged_sum(partials, model.total).alias("total_revenue"),
        merged_avg(partials, model.fare).alias("avg_fare"),
        merged_avg(partials, model.distance).alias("avg_distance"),
        merged_minutes("trip_duration_min").alias("avg_duration_min"),
        merged_avg(partials, "revenue_per_mile").alias("avg_revenue_per_mile"),
    )


def hourly_partials(trips: DataFrame, fare: str) -> DataFrame:
    """Partials of the hourly profile, by month."""
    amounts = [p for a in (fare, "avg_speed_mph") for p in amount_parts(trips, a)]
    keys = (MONTH, "pickup_hour", "pickup_dow", "pickup_borough")
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), *amounts, *minute_parts("trip_duration_min"))


def merge_hourly(partials: DataFrame, fare: str) -> DataFrame:
    """``aggregates.hourly_profile`` of all trips that went into the partials."""
    return partials.groupBy("pickup_hour", "pickup_dow", "pickup_borough").agg(
        F.sum("trip_count").alias("trip_count"),
        merged_avg(partials, fare).alias("avg_fare"),
        merged_minutes("trip_duration_min").alias("avg_duration_min"),
        merged_avg(partials, "avg_speed_mph").alias("avg_speed_mph"),
    )


def zone_week_bitmaps(trips: DataFrame, model: TripModel) -> DataFrame:
    """``(year_month, week, bucket, zones)``: the named zones with a trip in each week, as a bitmap, by month.

    Rows of one (month, week, zone) become one bit before the shuffle; the
    aggregate holds one fixed-size bitmap a group, whatever the trips."""
    zone = F.col(model.origin).cast("bigint")
    named = trips.filter(F.col("pickup_zone").isNotNull()).withColumn("week", sunday_week("pickup_date"))
    return named.groupBy(MONTH, "week", F.bitmap_bucket_number(zone).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(zone)).alias("zones")
    )


def active_zones(bitmaps: DataFrame) -> DataFrame:
    """``(week, active_zones)``: distinct zones of each week over all months, by OR of their bitmaps."""
    merged = bitmaps.groupBy("week", "bucket").agg(F.bitmap_or_agg("zones").alias("zones"))
    return merged.groupBy("week").agg(F.sum(F.bitmap_count("zones")).alias("active_zones"))


def cohort_bitmaps(daily: DataFrame, model: TripModel) -> DataFrame:
    """``(year_month, cohort_week, week, bucket, zones, revenue)`` of a daily aggregate, or of its merged partials.

    A zone's cohort is the first week of all its months; by month, the zones of
    a cohort that a week had are one bitmap."""
    zone = F.col(model.origin).cast("bigint")
    week = sunday_week("pickup_date")
    named = daily.filter(F.col("pickup_zone").isNotNull()).select(
        zone.alias("zone"), "pickup_zone", week.alias("week"), F.date_format("pickup_date", "yyyy-MM").alias(MONTH), "total_revenue"
    )
    first = named.groupBy("pickup_zone").agg(F.min("week").alias("cohort_week"))
    return named.join(first, "pickup_zone").groupBy(MONTH, "cohort_week", "week", F.bitmap_bucket_number("zone").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("zone")).alias("zones"), F.sum("total_revenue").alias("revenue")
    )


def merge_cohorts(bitmaps: DataFrame) -> DataFrame:
    """``views.zone_weekly_cohort`` from bitmaps of any months; where ids and names of zones are one to one."""
    merged = bitmaps.groupBy("cohort_week", "week", "bucket").agg(F.bitmap_or_agg("zones").alias("zones"), F.sum("revenue").alias("revenue"))
    weeks_since = (F.datediff("week", "cohort_week") / 7).cast("bigint")
    return merged.groupBy("cohort_week", weeks_since.alias("weeks_since_first")).agg(
        F.sum(F.bitmap_count("zones")).alias("active_zones"), F.round(F.sum("revenue"), 2).alias("revenue")
    )
