"""tripline — trip/transaction analytics on Spark DataFrames.

Every operator is a pure function from DataFrames to a DataFrame: no actions
inside operators, no Python UDFs, no driver-side loops over data.  Plans in
``tripline.plans`` compose them; ``tripline.plans.pipeline.Pipeline`` binds
them to the driver tables.
"""

from tripline.model import ORDERS_MODEL, TAXI_MODEL, TripModel

__all__ = ["TripModel", "TAXI_MODEL", "ORDERS_MODEL"]
