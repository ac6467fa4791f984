"""Property tests: the anomaly operator against a pandas brute force of the
same definition, and conservation laws of the pipeline on driver tables."""

import datetime as dt
import math
from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripline.operators import anomaly
from tripline.plans.pipeline import Pipeline


def brute_force(values, dates):
    """Rolling mean/std over the previous 6 same-weekday rows (min 3)."""
    s = pd.DataFrame({"d": pd.to_datetime(dates), "v": [float(v) for v in values]})
    s["dow"] = s["d"].dt.dayofweek
    out = []
    for _, grp in s.groupby("dow"):
        grp = grp.sort_values("d")
        roll = grp["v"].rolling(window=6, min_periods=3, closed="left")
        grp = grp.assign(mean=roll.mean(), std=roll.std())
        out.append(grp)
    return pd.concat(out).sort_values("d").reset_index(drop=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(min_value=0, max_value=50), min_size=1, max_size=40),
    gaps=st.lists(st.integers(min_value=1, max_value=9), min_size=40, max_size=40),
)
def test_zscore_matches_pandas_rolling(spark, values, gaps):
    d, dates = dt.date(2023, 1, 1), []
    for g in gaps[: len(values)]:
        d += dt.timedelta(days=g)
        dates.append(d)
    rows = [(x, "citywide", "citywide", v, Decimal(v)) for x, v in zip(dates, values)]
    series = spark.createDataFrame(
        rows, "pickup_date date, grain_type string, grain string, trip_count bigint, total_revenue decimal(28,4)"
    )
    got = (
        anomaly.anomalies(series).filter("metric = 'trip_count'").orderBy("pickup_date").toPandas()
    )
    exp = brute_force(values, dates)
    assert len(got) == len(exp)
    for g, (_, e) in zip(got.itertuples(), exp.iterrows()):
        if math.isnan(e["mean"]):
            assert g.rolling_mean is None or math.isnan(g.rolling_mean)
            assert not g.is_anomalous
            continue
        assert math.isclose(g.rolling_mean, e["mean"], rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(g.rolling_std, e["std"], rel_tol=1e-9, abs_tol=1e-9)
        if e["std"] > 1e-9:
            z = (e["v"] - e["mean"]) / e["std"]
            assert math.isclose(g.z_score, z, rel_tol=1e-9, abs_tol=1e-9)
            assert g.is_anomalous == (abs(z) >= 3.0)
        else:
            assert g.z_score is None or math.isnan(g.z_score)
            assert not g.is_anomalous


def test_conservation_laws(spark):
    p = Pipeline(spark, SF_SMALL)
    steps = p.step_counts.collect()[0]
    trips = p.trips.count()
    assert steps.final_cleaned_rows == trips
    assert steps.raw_rows_read == steps.invalid_rows_dropped + steps.duplicate_rows_dropped + trips
    assert p.daily.agg(F.sum("trip_count")).first()[0] == trips
    assert p.hourly.agg(F.sum("trip_count")).first()[0] == trips
    series = p.series
    city = series.filter("grain_type = 'citywide'").agg(F.sum("trip_count")).first()[0]
    assert city == trips
    # every reconciliation check passes on a consistent pipeline
    rec = p.checks.filter(F.col("name").startswith("row_count_reconciliation")).collect()
    assert len(rec) == 4 and all(r.passed for r in rec)


def test_checkpoint_dir_is_taken_from_session(spark):
    from tripline.session import ensure_checkpoint_dir, scratch_path

    d = ensure_checkpoint_dir(spark)
    assert d == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x").startswith(d + "/tripline-out/x-")
