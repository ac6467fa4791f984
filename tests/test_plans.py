"""Scale properties of the physical plans on the driver tables."""

import re

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.helpers import plan_text, plan_tree


def plan(spark, key):
    return plan_text(entry.queries()[key](spark, SF_SMALL))


def tree(spark, key):
    return plan_tree(entry.queries()[key](spark, SF_SMALL))


def test_daily_aggregate_shuffles_twice_with_map_side_combine(spark):
    t = tree(spark, "agg_daily_zone")
    lines = t.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2  # dedupe + daily groups
    # each shuffle is fed by a partial (map-side) HashAggregate
    for i in exchanges:
        assert "HashAggregate" in lines[i + 1]
    assert "partial_count" in t and "partial_sum" in t


def test_only_the_dimension_is_hinted(spark):
    p = plan(spark, "enrich_zones")
    assert p.count("BroadcastHashJoin LeftOuter") == 2  # pickup + dropoff roles
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_cleaning_predicates_reach_every_fact_scan(spark):
    p = plan(spark, "clean_trips")
    pushed = re.findall(r"PushedFilters: \[(.*)\]", p)
    assert any("LessThanOrEqual(l_quantity,45.0)" in f for f in pushed)
    assert any("GreaterThanOrEqual(c_nationkey,1)" in f for f in pushed)
    assert any("LessThanOrEqual(s_nationkey,23)" in f for f in pushed)


def test_year_rule_reaches_the_scan(spark):
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan(spark, "clean_trips_year"))
    assert any("GreaterThanOrEqual(o_orderdate,1997-01-01" in f and "LessThan(o_orderdate,1998-01-01" in f
               for f in pushed)


def test_anomaly_window_is_partitioned(spark):
    t = tree(spark, "anomaly_zscore")
    windows = [line for line in t.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows
    # partitioned by (grain_type, grain, metric, weekday), 6 prior rows
    assert all(re.search(r"windowspecdefinition\(grain_type#\d+, grain#\d+, metric#\d+, _w\d+#\d+", w)
               for w in windows)
    assert all("RowFrame, -6, -1" in w for w in windows)


def test_checks_have_no_joins_between_counts(spark):
    p = plan(spark, "dq_results")
    assert "Union" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
