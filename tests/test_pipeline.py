"""Stages of the pipeline over the driver tables."""

from tests.conftest import SF_SMALL
from tripline.plans.pipeline import Pipeline


def test_sessions_do_not_share_plans(spark):
    other = spark.newSession()
    assert Pipeline(spark, SF_SMALL).raw.sparkSession is not Pipeline(other, SF_SMALL).raw.sparkSession


def test_every_nation_has_a_zone(spark):
    assert Pipeline(spark, SF_SMALL).zones.count() == 25


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_branches_share_one_deduplication(spark):
    plan = executed(Pipeline(spark, SF_SMALL).checks)
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_scratch_folders_go_with_the_application(spark):
    import os

    from tripline.session import ensure_checkpoint_dir, scratch_path

    before = set(os.listdir(f"{ensure_checkpoint_dir(spark)}/tripline-out")) if os.path.isdir(
        f"{ensure_checkpoint_dir(spark)}/tripline-out") else set()
    Pipeline(spark, SF_SMALL).checks.collect()
    Pipeline(spark, SF_SMALL).step_counts.collect()
    folder = f"{ensure_checkpoint_dir(spark)}/tripline-out"
    assert not os.path.isdir(folder) or set(os.listdir(folder)) == before  # nothing stored
    assert os.path.isdir(scratch_path(spark, "x"))
