"""Role binding: which physical column plays which part of a trip.

Operators take ``(df, model)`` so the same code serves the taxi schema and
the order/lineitem tables the tests run on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, LongType, StringType, TimestampType

# Derived columns every enriched trip table carries (names are fixed values).
DERIVED_COLUMNS = (
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "trip_duration_min",
    "avg_speed_mph",
    "revenue_per_mile",
    "pickup_date",
    "pickup_hour",
    "pickup_dow",
    "year_month",
)


@dataclass(frozen=True)
class TripModel:
    start: str
    end: str
    origin: str
    dest: str
    party: str
    distance: str
    fare: str
    total: str
    payment: str
    vendor: str
    natural_key: tuple[str, ...]
    max_duration_s: int
    max_distance: float
    max_fare: float
    zone_range: tuple[int, int]
    year: int | None = None
    # data-quality contract: inclusive value ranges (min, max)
    fare_range: tuple[float, float] = field(default=(0.01, 1000))
    distance_range: tuple[float, float] = field(default=(0.01, 200))

    @property
    def null_checked(self) -> tuple[str, ...]:
        return (self.start, self.end, self.origin, self.dest, self.total)

    @property
    def expected_columns(self) -> frozenset[str]:
        roles = (
            self.vendor, self.start, self.end, self.party, self.distance,
            self.origin, self.dest, self.payment, self.fare, self.total,
        )
        return frozenset(roles) | frozenset(DERIVED_COLUMNS)


# Taxi binding: fixed values of the trip-record contract.
TAXI_MODEL = TripModel(
    start="tpep_pickup_datetime",
    end="tpep_dropoff_datetime",
    origin="PULocationID",
    dest="DOLocationID",
    party="passenger_count",
    distance="trip_distance",
    fare="fare_amount",
    total="total_amount",
    payment="payment_type",
    vendor="VendorID",
    natural_key=(
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "total_amount",
    ),
    max_duration_s=6 * 3600,
    max_distance=200,
    max_fare=1000,
    zone_range=(1, 263),
    year=2023,
    fare_range=(0.01, 1000),
    distance_range=(0.01, 200),
)

# Order/lineitem binding used on the driver tables (see FIXTURES.md §3).
ORDERS_MODEL = TripModel(
    start="o_orderdate",
    end="l_shipdate",
    origin="c_nationkey",
    dest="s_nationkey",
    party="l_linenumber",
    distance="l_quantity",
    fare="l_extendedprice",
    total="total_amount",
    payment="o_orderpriority",
    vendor="l_suppkey",
    natural_key=("l_orderkey", "l_linenumber"),
    max_duration_s=365 * 86400,
    max_distance=45,
    max_fare=90000,
    zone_range=(1, 23),
    year=None,
    fare_range=(0.01, 90000),
    distance_range=(0.01, 45),
)


# Canonical raw trip-record schema (fixed values: 19 columns, in file order).
TAXI_CANONICAL = [
    ("VendorID", LongType()),
    ("tpep_pickup_datetime", TimestampType()),
    ("tpep_dropoff_datetime", TimestampType()),
    ("passenger_count", DoubleType()),
    ("trip_distance", DoubleType()),
    ("RatecodeID", DoubleType()),
    ("store_and_fwd_flag", StringType()),
    ("PULocationID", LongType()),
    ("DOLocationID", LongType()),
    ("payment_type", LongType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("airport_fee", DoubleType()),
]
# Known spelling variants of canonical columns.
TAXI_ALIASES = {"airport_fee": ("Airport_fee",)}
