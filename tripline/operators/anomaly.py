"""Weekday-adjusted rolling z-score over daily series.

For each (grain, metric, weekday) series ordered by date, the baseline is
the previous 6 *occurrences* (rows, not calendar days; the current row is
excluded).  Mean and sample std need at least 3 values; z is NULL unless
std > 0; a point is anomalous when |z| >= 3.

Moments are exact, with ten decimals: a value is a whole number of 10^-4 (the
high limb, DECIMAL(38,0)) and one of 10^-10 below it (the low limb, under
10^6), so n, Σx and Σx² fit limb by limb, and the variance numerator
n·Σx² − (Σx)² is put together from limbs with carries, without a rounding or
a cancellation.  A constant history therefore has std exactly 0, and the
result does not depend on how rows were partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripline.functions import MONEY_SCALE, WIDE_INT

# Fixed values of the method and of its text report.
ROLLING_WINDOW_OCCURRENCES = 6
MIN_PERIODS = 3
Z_THRESHOLD = 3.0
METRICS = ("trip_count", "total_revenue")
REPORT_HEADER = (
    "# Anomaly Detection Report",
    "",
    "Method: weekday-adjusted rolling z-score "
    "(window={window} same-weekday occurrences, threshold=|z|>={threshold}).",
    "",
    "Total (grain, metric, date) points scored: {scored}",
    "Flagged anomalies: {flagged}",
    "",
    "| Date | Grain | Metric | Value | Rolling Mean | Z-score |",
    "|---|---|---|---|---|---|",
)
REPORT_ROW = "| %s | %s | %s | %.0f | %.0f | %.2f |"

VALUE = DecimalType(28, 10)
# Low limbs to one of the high limb.
LIMB = 1_000_000


def long_series(series: DataFrame) -> DataFrame:
    """Unpivot ``trip_count`` / ``total_revenue`` into ``(metric, value)``."""
    wide = series.select(
        "pickup_date", "grain_type", "grain",
        *[F.col(m).cast(VALUE).alias(m) for m in METRICS],
    )
    return wide.unpivot(["pickup_date", "grain_type", "grain"], list(METRICS), "metric", "value")


def _carried(c: Column) -> tuple[Column, Column]:
    """A whole number as (carry, rest): carry * LIMB + rest, 0 <= rest < LIMB, both exact."""
    rest = F.pmod(c, F.lit(LIMB).cast(WIDE_INT))
    return F.call_function("div", c - rest, F.lit(LIMB).cast(WIDE_INT)).cast(WIDE_INT), rest


def weekday_zscore(points: DataFrame) -> DataFrame:
    """Score ``(pickup_date, grain_type, grain, metric, value)`` rows."""
    w = (
        Window.partitionBy("grain_type", "grain", "metric", F.weekday("pickup_date"))
        .orderBy("pickup_date")
        .rowsBetween(-ROLLING_WINDOW_OCCURRENCES, -1)
    )
    scaled = F.col("value") * F.lit(MONEY_SCALE)
    low = ((scaled - F.floor(scaled)).cast(DecimalType(11, 10)) * F.lit(LIMB)).cast("bigint")
    x, y = F.col("_x"), F.col("_y")
    scored = points.withColumns({"_x": F.floor(scaled).cast(WIDE_INT), "_y": low}).select(
        "pickup_date", "grain_type", "grain", "metric", "value",
        F.count("_x").over(w).alias("_n"),
        *[F.sum(c).over(w).alias(name) for name, c in
          (("_s1", x), ("_s2", x * x), ("_l1", y), ("_l2", y * y), ("_xl", x * y))],
    )
    n, s1, s2 = F.col("_n"), F.col("_s1"), F.col("_s2")
    enough = n >= MIN_PERIODS
    # n(n-1)·var·10^8 = high + (middle + low / LIMB) / LIMB, with 0 <= middle, low < LIMB
    wide = n.cast(WIDE_INT)
    carry, low = _carried(wide * F.col("_l2") - F.col("_l1").cast(WIDE_INT) * F.col("_l1"))
    carry, middle = _carried((wide * F.col("_xl") - s1 * F.col("_l1")) * 2 + carry)
    high = wide * s2 - s1 * s1 + carry
    below = (middle.cast("double") + low.cast("double") / LIMB) / LIMB
    # try_divide: no division is ever attempted on a short history (n < 2)
    total = s1.cast("double") + F.col("_l1").cast("double") / LIMB
    mean = F.try_divide(total, n * float(MONEY_SCALE))
    var = F.try_divide(high.cast("double") + below, (n * (n - 1)).cast("double"))
    std = F.sqrt(var) / float(MONEY_SCALE)
    value = F.col("value").cast("double")
    z = F.try_divide(value - mean, std)
    return scored.select(
        "pickup_date",
        "grain_type",
        "grain",
        "metric",
        value.alias("value"),
        F.when(enough, mean).alias("rolling_mean"),
        F.when(enough, std).alias("rolling_std"),
        F.when(enough & ((high > 0) | (middle > 0) | (low > 0)), z).alias("z_score"),
    ).withColumn(
        "is_anomalous", F.coalesce(F.abs(F.col("z_score")) >= Z_THRESHOLD, F.lit(False))
    )


def anomalies(series: DataFrame) -> DataFrame:
    """Every (grain, metric) of a city-wide + borough daily series, scored.
    Output: pickup_date, grain_type, grain, metric, value, rolling_mean,
    rolling_std, z_score, is_anomalous; the type tells the total from a borough
    of the same name."""
    return weekday_zscore(long_series(series))


def flag_counts(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("points_scored"),
        F.count_if("is_anomalous").alias("points_flagged"),
    )


def top_by_abs_z(scored: DataFrame, n: int = 50) -> DataFrame:
    """Largest |z| first, with a total order for ties; TakeOrdered plan."""
    return (
        scored.filter("is_anomalous")
        .orderBy(F.abs("z_score").desc(), "pickup_date", "grain", "metric")
        .limit(n)
    )


def report_lines(top: DataFrame) -> DataFrame:
    """Markdown table lines of the anomaly report, one per flagged point."""
    return top.select(
        "pickup_date", "grain", "metric", "value", "rolling_mean", "z_score",
        F.format_string(
            REPORT_ROW,
            F.col("pickup_date").cast("string"),
            F.col("grain"),
            F.col("metric"),
            F.round("value", 0),
            F.round("rolling_mean", 0),
            F.round("z_score", 2),
        ).alias("line"),
    )
