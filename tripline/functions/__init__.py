"""Column-expression helpers (all built-in Spark functions, JVM side).

Money and averages are computed so the answer does not depend on how the
rows were partitioned: amounts are summed as DECIMAL, and an average is an
exact DECIMAL sum divided once, in double, by the count.  No value is cut: a
double that a DECIMAL does not hold exactly is summed as a double.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

# Doubles are summed at this scale where it holds them exactly: 18 digits
# before the point and 10 after it, with room for 10^10 rows in the sum.
EXACT = DecimalType(28, 10)
# Unscaled integer form of an amount (value * 10^4), for exact moments.
MONEY_SCALE = 10_000
WIDE_INT = DecimalType(38, 0)

# Weekday labels as produced by date_format(d, 'E'); fixed values, Monday first.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def held_exactly(c: Column, scale: DecimalType) -> Column:
    """Whether a double is a value of ``scale``, so that no digit is cut."""
    return F.coalesce(c.try_cast(scale).cast("double") == c, F.lit(False))


def _sum_of_doubles(c: Column, scale: DecimalType) -> Column:
    """SUM of doubles as a double: exact over the values that ``scale`` holds,
    plus the double sum of the others (tiny, huge, infinite, NaN)."""
    held = held_exactly(c, scale)
    exact = F.sum(F.when(held, c.try_cast(scale))).cast("double")
    rest = F.sum(F.when(~held, c))
    return F.when(
        F.count(c) > 0, F.coalesce(exact, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))
    )


def exact_sum(df: DataFrame, name: str) -> Column:
    """SUM of an amount: in its own type for DECIMAL and integer columns, a
    double for others."""
    if isinstance(df.schema[name].dataType, (DecimalType, IntegralType)):
        return F.sum(name)
    return _sum_of_doubles(F.col(name).cast("double"), EXACT)


def exact_avg(df: DataFrame, name: str) -> Column:
    """AVG whose sum is ``exact_sum``: one double division by the count."""
    return F.try_divide(exact_sum(df, name).cast("double"), F.count(name).cast("double"))


# Scale at which averages are summed exactly (shortest text of each double, up
# to 18 decimals and 14 digits before the point, for 10^6 groups in a sum).
AVG_TEXT = DecimalType(32, 18)


def avg_of_doubles(c: Column | str) -> Column:
    """AVG of double values (e.g. per-group averages) summed exactly as
    DECIMAL, so the result does not depend on the order rows arrive in."""
    c = col(c)
    return F.try_divide(_sum_of_doubles(c, AVG_TEXT), F.count(c).cast("double"))


def minutes_avg(minutes: Column | str) -> Column:
    """AVG of a whole-second duration given in minutes, exact in seconds."""
    m = col(minutes)
    seconds = F.round(m * 60.0).cast("bigint")
    return F.try_divide(F.sum(seconds).cast("double"), F.count(m) * 60.0)


def sunday_week(d: Column | str) -> Column:
    """Start of the Sunday-based week containing date ``d``."""
    d = col(d)
    return F.date_add(d, 1 - F.dayofweek(d))


def month_start(d: Column | str) -> Column:
    return F.trunc(col(d), "MM")


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(col(ts), "E")


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev * 100 in double; NULL when prev is NULL or 0."""
    cur, prev = cur.cast("double"), prev.cast("double")
    return F.try_divide(cur - prev, prev) * 100.0


def fmt_count(c: Column | str) -> Column:
    """Integer with thousands separators: 60000 -> '60,000'."""
    return F.format_number(col(c).cast("bigint"), 0)


def fmt_pct(ratio: Column, decimals: int) -> Column:
    """ratio -> percent text with a fixed number of decimals ('1.2500')."""
    return F.format_string(f"%.{decimals}f", F.round(ratio * 100.0, decimals))


def fill(template: str, **parts) -> Column:
    """Fill a ``{name}`` text template with Columns or plain values, as one
    concat expression (NULL if any Column part is NULL)."""
    pieces = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if field is not None:
            v = parts[field]
            pieces.append(v if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*pieces) if pieces else F.lit("")
