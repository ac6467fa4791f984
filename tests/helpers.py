"""Hand-made fixture frames (FIXTURES.md §2 and §4)."""

import datetime as dt

from pyspark.sql import types as T

from tripline.model import TAXI_CANONICAL

TAXI_SCHEMA = T.StructType([T.StructField(n, t) for n, t in TAXI_CANONICAL])


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def taxi_row(**kw):
    """A valid 2023 trip; keyword arguments override columns."""
    base = {
        "VendorID": 1,
        "tpep_pickup_datetime": ts("2023-03-01 08:00:00"),
        "tpep_dropoff_datetime": ts("2023-03-01 08:20:00"),
        "passenger_count": 1.0,
        "trip_distance": 3.0,
        "RatecodeID": 1.0,
        "store_and_fwd_flag": "N",
        "PULocationID": 132,
        "DOLocationID": 236,
        "payment_type": 1,
        "fare_amount": 20.0,
        "extra": 0.0,
        "mta_tax": 0.5,
        "tip_amount": 3.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 0.3,
        "total_amount": 25.0,
        "congestion_surcharge": 2.5,
        "airport_fee": 0.0,
    }
    base.update(kw)
    return tuple(base[n] for n, _ in TAXI_CANONICAL)


def taxi_frame(spark, rows):
    return spark.createDataFrame(rows, TAXI_SCHEMA)


def zone_frame(spark, rows=None):
    rows = rows or [(132, "JFK Airport", "Queens"), (236, "Upper East Side North", "Manhattan"),
                    (1, "Newark Airport", "EWR")]
    return spark.createDataFrame(rows, "zone_id int, zone string, borough string")


def plan_text(df) -> str:
    """Full formatted physical plan (no truncation)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan_tree(df) -> str:
    """Physical plan as a tree (one line per operator)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
