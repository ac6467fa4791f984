"""Bytes and records that scans really read, from Spark's event log.

A scan node knows the sizes of the files that it opens; what its tasks read,
after column pruning and skipped row groups, is in their input metrics, which
Spark writes to the event log (``EVENT_LOG_CONF`` turns it on for a session).
The log is read back by Spark as lines of JSON.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = "spark.jobGroup.id"
# A log that can be read while the session writes it: one plain file.  Reads of
# several ranges at once are left out of Hadoop's counts, so they are off.
EVENT_LOG_CONF = {
    "spark.hadoop.parquet.hadoop.vectored.io.enabled": "false",
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false",
}
WAIT_SECONDS = 20.0


def log_path(spark: SparkSession) -> str | None:
    """The event log of this session; None when it writes none that can be read."""
    conf = spark.sparkContext.getConf()
    if any(conf.get(key, "") != value for key, value in EVENT_LOG_CONF.items()):
        return None
    return f"{conf.get('spark.eventLog.dir', 'file:///tmp/spark-events').rstrip('/')}/{spark.sparkContext.applicationId}*"


@contextmanager
def job_group(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh job group, so that the log tells the jobs run inside from others."""
    group = f"{label}-{uuid.uuid4().hex[:8]}"
    before = spark.sparkContext.getLocalProperty(GROUP)
    spark.sparkContext.setJobGroup(group, label)
    try:
        yield group
    finally:
        spark.sparkContext.setLocalProperty(GROUP, before)


def _field(*names: str) -> Column:
    return F.get_json_object("value", "$" + "".join(f"['{n}']" for n in names))


def _task_input(lines: DataFrame) -> DataFrame:
    """``(group, bytes_read, records_read, tasks, ended)`` by job group, from the log's lines."""
    event = lines.withColumn("event", _field("Event"))
    jobs = event.filter(F.col("event") == "SparkListenerJobStart").select(
        _field("Properties", GROUP).alias("group"), _field("Job ID").cast("bigint").alias("job"),
        F.from_json(_field("Stage IDs"), "array<bigint>").alias("stages"),
    )
    ends = event.filter(F.col("event") == "SparkListenerJobEnd").select(_field("Job ID").cast("bigint").alias("job"), F.lit(1).alias("end"))
    running = jobs.join(ends, "job", "left").groupBy("group").agg((F.count("end") == F.count("job")).alias("ended"))
    metric = ("Task Metrics", "Input Metrics")
    tasks = event.filter(F.col("event") == "SparkListenerTaskEnd").select(
        _field("Stage ID").cast("bigint").alias("stage"),
        _field(*metric, "Bytes Read").cast("bigint").alias("bytes"),
        _field(*metric, "Records Read").cast("bigint").alias("records"),
    )
    stages = jobs.select("group", F.explode("stages").alias("stage")).distinct()
    summed = stages.join(tasks, "stage").groupBy("group").agg(
        F.sum("bytes").alias("bytes_read"), F.sum("records").alias("records_read"), F.count(F.lit(1)).alias("tasks")
    )
    return running.join(summed, "group", "left")


def input_of(spark: SparkSession, groups: list[str]) -> dict[str, tuple[int, int]] | None:
    """``{group: (bytes read, records read)}`` of ended job groups; None without a log.  Waits until the log has them."""
    path = log_path(spark)
    if path is None:
        return None
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "true")
    deadline = time.monotonic() + WAIT_SECONDS
    while True:
        rows = _task_input(own.read.text(path)).filter(F.col("group").isin(groups)).collect()  # one row a group
        if len(rows) == len(groups) and all(r.ended for r in rows):
            return {r.group: (r.bytes_read or 0, r.records_read or 0) for r in rows}
        if time.monotonic() > deadline:
            return None
        time.sleep(0.5)
