"""Views published to a folder, opened by other sessions."""

import pytest

from tests.conftest import SF_SMALL
from tripline.plans import adhoc, published, views
from tripline.plans.pipeline import Pipeline


def test_views_are_read_by_another_session(spark, tmp_dir):
    p = Pipeline(spark, SF_SMALL)
    names = ["vw_daily_kpis", "vw_zone_leaderboard"]
    built = {n: p.view_builders()[n]() for n in names}
    published.publish_views(spark, built, tmp_dir)
    other = spark.newSession()
    assert published.open_views(other, tmp_dir) == names
    for name in names:
        want = views.ordered(name, built[name])
        assert other.table(name).columns == want.columns
        assert other.table(name).collect() == want.collect()
    answer = adhoc.guarded_query(other, "SELECT COUNT(*) AS n FROM vw_daily_kpis", views.VIEW_NAMES)
    assert answer.first().n == built["vw_daily_kpis"].count()


def test_readers_see_whole_versions_only(spark, tmp_dir):
    def frames(value):
        return {n: spark.createDataFrame([(value, True)], "name string, passed boolean") for n in ("vw_a", "vw_b")}

    def seen():
        other = spark.newSession()
        return [other.table(n).first().name for n in published.open_views(other, tmp_dir)]

    with pytest.raises(FileNotFoundError):
        published.open_views(spark, tmp_dir)
    first = published.publish_views(spark, frames("one"), tmp_dir)
    assert seen() == ["one", "one"]
    late = spark.newSession()
    published.open_views(late, tmp_dir)

    broken = frames("two")
    broken["vw_b"] = broken["vw_b"].selectExpr("raise_error('lost') AS name", "passed")
    with pytest.raises(Exception, match="lost"):
        published.publish_views(spark, broken, tmp_dir)
    assert seen() == ["one", "one"]

    published.publish_views(spark, frames("three"), tmp_dir)
    assert seen() == ["three", "three"] and late.table("vw_a").first().name == "one"
    published.publish_views(spark, frames("four"), tmp_dir)
    assert seen() == ["four", "four"]
    assert published.published(spark, tmp_dir).count() == 6
    with pytest.raises(Exception, match=first):  # only the last two versions stay
        late.table("vw_a").collect()


def test_wrong_names_are_refused(spark, tmp_dir):
    with pytest.raises(ValueError):
        published.publish_views(spark, {}, tmp_dir)
    published.publish_views(spark, {"vw_a": spark.range(3)}, tmp_dir)
    with pytest.raises(ValueError, match="vw_x"):
        published.open_views(spark.newSession(), tmp_dir, ["vw_a", "vw_x"])
