"""Views that outlast a session: published to a folder and opened by any other.

``publish_views`` writes every view's rows to a folder of a new version, and
one entry a view to the list of versions last, in one file.  So readers see
all views of the old version or all of the new one; a publication that dies
on its way is not listed, and the next one starts anew.  ``open_views`` makes
the views of the latest version temporary views of the session it is given,
sorted as ``views.ordered`` has them.  The last ``keep`` versions stay for
readers that opened them before.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.plans import views

LIST_SCHEMA = "version string, published_at timestamp, view_name string"


def published(spark: SparkSession, path: str) -> DataFrame:
    """``(version, published_at, view_name)`` of all publications; empty before the first."""
    try:
        return spark.read.schema(LIST_SCHEMA).parquet(f"{path.rstrip('/')}/versions")
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LIST_SCHEMA)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Versions with folders to read, the latest first; one row a publication."""
    listed = published(spark, path).select("version", "published_at").distinct()
    return [r.version for r in listed.orderBy(F.desc("published_at"), F.desc("version")).collect()]


def publish_views(spark: SparkSession, frames: dict[str, DataFrame], path: str, keep: int = 2) -> str:
    """Write the views as a new version and list it; returns the version."""
    if not frames:
        raise ValueError("no view to publish")
    if keep < 1:
        raise ValueError("the new version must stay")
    path, now = path.rstrip("/"), dt.datetime.now(dt.timezone.utc)
    version = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    for name, frame in frames.items():
        frame.write.mode("errorifexists").parquet(f"{path}/{version}/{name}")
    entries = spark.createDataFrame([(version, now, name) for name in frames], LIST_SCHEMA)
    entries.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    for old in _versions(spark, path)[keep:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return version


def open_views(spark: SparkSession, path: str, names: list[str] | None = None) -> list[str]:
    """Make the latest version's views (all, or only ``names``) views of this session; returns their names."""
    path = path.rstrip("/")
    latest = _versions(spark, path)[:1]
    if not latest:
        raise FileNotFoundError(f"no published views in {path}")
    held = [r.view_name for r in published(spark, path).filter(F.col("version") == latest[0]).orderBy("view_name").collect()]
    missing = sorted(set(names or []) - set(held))
    if missing:
        raise ValueError(f"not published: {', '.join(missing)}")
    chosen = held if names is None else [n for n in held if n in names]
    for name in chosen:
        views.ordered(name, spark.read.parquet(f"{path}/{latest[0]}/{name}")).createOrReplaceTempView(name)
    return chosen
