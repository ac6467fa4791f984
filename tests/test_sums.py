"""Sums and averages of amounts that a DECIMAL does not hold."""

import math

from tripline.functions import avg_of_doubles, exact_avg, exact_sum


def both(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    return df.agg(exact_sum(df, "v").alias("s"), exact_avg(df, "v").alias("a"), avg_of_doubles("v").alias("b")).first()


def test_tiny_amounts_are_kept(spark):
    r = both(spark, [0.00004, 0.00004])
    assert (r.s, r.a, r.b) == (0.00008, 0.00004, 0.00004)
    assert both(spark, [1e-25, 1e-25]).a == 1e-25


def test_huge_and_infinite_amounts_do_not_end_the_job(spark):
    assert both(spark, [1e15, 1.5]).s == 1e15 + 1.5
    assert both(spark, [1e300, 1e300, 0.25]).s == 2e300
    assert both(spark, [math.inf, 1.0]).s == math.inf
    assert math.isnan(both(spark, [math.nan, 1.0]).a)


def test_cents_are_exact_and_nulls_left_out(spark):
    r = both(spark, [0.1] * 10 + [None])
    assert (r.s, r.a, r.b) == (1.0, 0.1, 0.1)
    none = both(spark, [None, None])
    assert (none.s, none.a, none.b) == (None, None, None)


def test_decimal_columns_keep_their_scale(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(20,8)) AS v FROM VALUES ('0.00000001'), ('2.5') t(v)")
    assert str(df.agg(exact_sum(df, "v")).first()[0]) == "2.50000001"
