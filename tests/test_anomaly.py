"""Weekday-adjusted rolling z-score (FIXTURES.md §4)."""

import datetime as dt
import random
from decimal import Decimal
from fractions import Fraction

import pytest

from tripline.operators import anomaly


def series(spark, values, start=dt.date(2023, 1, 2), step_days=7, skip=()):
    rows, d = [], start
    for i, v in enumerate(values):
        if i not in skip:
            rows.append((d, "citywide", "citywide", v, Decimal(v)))
        d += dt.timedelta(days=step_days)
    return spark.createDataFrame(
        rows, "pickup_date date, grain_type string, grain string, trip_count bigint, "
              "total_revenue decimal(28,4)"
    )


def scored(spark, values, **kw):
    out = anomaly.anomalies(series(spark, values, **kw)).filter("metric = 'trip_count'")
    return out.orderBy("pickup_date").collect()


def test_zscore_basic(spark):
    rows = scored(spark, [100, 110, 120, 200])
    assert [r.z_score for r in rows[:3]] == [None, None, None]
    assert [r.is_anomalous for r in rows[:3]] == [False, False, False]
    last = rows[3]
    assert last.rolling_mean == pytest.approx(110.0)
    assert last.rolling_std == pytest.approx(10.0)
    assert last.z_score == pytest.approx(9.0)
    assert last.is_anomalous is True


def test_window_is_six_occurrences(spark):
    rows = scored(spark, [1000, 10, 20, 30, 40, 50, 60, 70])
    assert rows[7].rolling_mean == pytest.approx(35.0)  # 10..60; the 1000 is out of the window


def test_constant_history_is_not_flagged(spark):
    rows = scored(spark, [5, 5, 5, 9])
    assert rows[3].rolling_std == 0.0
    assert rows[3].z_score is None
    assert rows[3].is_anomalous is False


def test_missing_week_uses_previous_occurrences(spark):
    # the 3rd week is absent: the 5th value still sees 4 earlier occurrences
    rows = scored(spark, [10, 20, 30, 40, 50], skip=(2,))
    assert len(rows) == 4
    assert rows[3].rolling_mean == pytest.approx((10 + 20 + 40) / 3)


@pytest.mark.parametrize("base", ["0", "123456789012", "-5000"])
def test_ten_decimals_score_as_a_brute_force_does(spark, base):
    rng = random.Random(1)
    values = [Decimal(base) + Decimal(rng.choice([0, 1, 2, 10**6 - 1, 10**6, 10**6 + 1, rng.randrange(10**7)])).scaleb(-10) for _ in range(40)]
    rows = [(dt.date(2023, 1, 2) + dt.timedelta(days=7 * i), "citywide", "citywide", i, v) for i, v in enumerate(values)]
    kind = "pickup_date date, grain_type string, grain string, trip_count bigint, total_revenue decimal(28,10)"
    out = anomaly.anomalies(spark.createDataFrame(rows, kind)).filter("metric = 'total_revenue'").orderBy("pickup_date").collect()
    flagged = 0
    for i, r in enumerate(out):
        past = [Fraction(v) for v in values[max(0, i - 6) : i]]
        assert r.value == float(values[i])
        if len(past) < 3:
            assert r.rolling_mean is None and r.z_score is None
            continue
        mean = sum(past) / len(past)
        var = sum((x - mean) ** 2 for x in past) / (len(past) - 1)
        assert r.rolling_mean == pytest.approx(float(mean), rel=1e-14)
        assert r.rolling_std == pytest.approx(float(var) ** 0.5, rel=1e-12)
        assert (r.z_score is None) == (var == 0)
        flagged += var > 0
    assert flagged > 20


def test_weekdays_are_separate_series(spark):
    # daily values: each weekday has only one occurrence -> nothing scored
    rows = scored(spark, [1, 2, 3, 4, 5, 6, 7], step_days=1)
    assert all(r.rolling_mean is None for r in rows)


def test_revenue_metric_is_scored_exactly(spark):
    out = anomaly.anomalies(series(spark, [100, 110, 120, 200]))
    rev = out.filter("metric = 'total_revenue'").orderBy("pickup_date").collect()
    assert rev[3].z_score == pytest.approx(9.0)
    counts = anomaly.flag_counts(out).collect()[0]
    assert (counts.points_scored, counts.points_flagged) == (8, 2)
