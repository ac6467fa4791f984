"""Driver contract, plan properties, and every query vs its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.helpers import plan_text
from tools.compare import compare_one, duck
from tripline.plans import catalog

# the optional training-data queries have tests of their own
KEYS = set(catalog.queries())

# file sizes are not in the tables: tests/test_sources.py holds them against the file system
NO_SQL = {"ingest_manifest_bytes"}

FORBIDDEN_NODES = (
    "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
    "CartesianProduct", "BroadcastNestedLoopJoin",
)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"pickup_date", "grain", "metric", "z_score", "is_anomalous"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert KEYS - NO_SQL <= set(entry.oracle_sql())
    assert len(KEYS) == 65


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(KEYS - NO_SQL))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    plan = plan_text(df)
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{key}: {node} in plan"
    ok, msg = compare_one(df, con, entry.oracle_sql()[key])
    assert ok, f"{key}: {msg}"
