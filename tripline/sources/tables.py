"""Driver tables and their binding to the trip model (FIXTURES.md §3).

Trip fact   = lineitem ⋈ orders ⋈ customer ⋈ supplier (inner joins).
Zones       = nation ⋈ region.
Events      = hour-of-day / weekday source (timestamps with a time part).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType

from tripline.functions import weekday_name

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Source files that make up the trip fact (the "monthly files" of the binding).
TRIP_SOURCE_TABLES = ("lineitem", "orders", "customer", "supplier")
# The file whose rows are the grain of the trip fact.
TRIP_GRAIN_TABLE = "lineitem"
# Tables the zone dimension reads.
ZONE_TABLES = ("nation", "region")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def order_trips(spark: SparkSession, sf_dir: str, with_copies: bool = False) -> DataFrame:
    """Raw trip rows.  ``with_copies`` appends an exact copy of every
    lineitem with l_linenumber = 1, giving whole-row duplicates to remove."""
    # No per-table projections: column pruning reaches every scan anyway.
    li = read_table(spark, sf_dir, "lineitem")
    if with_copies:
        li = li.unionByName(li.filter(F.col("l_linenumber") == 1))
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    # Join order and strategy are Catalyst's: the cleaning filter placed on top
    # is split and pushed into each scan; AQE sizes the joins at run time.
    joined = (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
    )
    total = (
        F.col("l_extendedprice").cast(DecimalType(18, 2))
        * (F.lit(1).cast(DecimalType(4, 2)) - F.col("l_discount").cast(DecimalType(4, 2)))
    ).cast(DecimalType(18, 4))  # 2 + 2 decimals: the product is exact
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey",
        "o_orderdate", "l_shipdate", "c_nationkey", "s_nationkey", "l_quantity",
        "l_extendedprice", "l_discount", "o_orderpriority",
        total.alias("total_amount"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension ``(zone_id, zone, borough)``."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("zone_id"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("borough"),
    )


# Two tables as two files of one source, for the drift reader: canonical
# columns and the spellings that the files have.
DRIFT_TABLES = ("customer", "supplier")
DRIFT_CANONICAL = [
    ("key", LongType()),
    ("name", StringType()),
    ("nationkey", LongType()),
    ("acctbal", DoubleType()),
    ("mktsegment", StringType()),
]
DRIFT_ALIASES = {
    "key": ("c_custkey", "s_suppkey"),
    "name": ("c_name", "s_name"),
    "nationkey": ("c_nationkey", "s_nationkey"),
    "acctbal": ("c_acctbal", "s_acctbal"),
    "mktsegment": ("c_mktsegment",),
}


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of enriched trips, for hour-of-day operators:
    hour and weekday from ``ts``, borough = event_type, fare = value.  An event
    lasts ``value`` minutes, in whole seconds, and covers the distance ``k`` of
    its props; text without a number there leaves the distance NULL."""
    ev = read_table(spark, sf_dir, "events").select("ts", "event_type", "value", "props")
    minutes = F.round(F.col("value") * 60.0) / 60.0
    distance = F.get_json_object("props", "$.k").try_cast("double")
    return ev.select(
        F.hour("ts").alias("pickup_hour"),
        weekday_name("ts").alias("pickup_dow"),
        F.col("event_type").alias("pickup_borough"),
        F.col("value").alias("fare"),
        minutes.alias("trip_duration_min"),
        F.round(F.try_divide(distance, minutes / 60.0), 2).alias("avg_speed_mph"),
    )
