"""Repeatable loads of partitioned tables, with a ledger of the files loaded.

The source is a hive-partitioned Parquet folder (months of trips).  A load
lists its files, without reading them, and compares (path, bytes) with the
ledger.  Partitions with a new, changed or vanished file are read, and only
those; each replaces its partition of the target (dynamic overwrite), the
others stay as they are.  The ledger is written last, so a load that dies is
done again in full by the next one, with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.sources.files import list_files, read_partitioned, write_partitioned

LEDGER_COLUMNS = "file_path string, bytes bigint"


def read_ledger(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """``(file_path, bytes, <partition>)`` of the files loaded so far; empty before the first load."""
    schema = f"{LEDGER_COLUMNS}, {partition_col} string"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def source_files(spark: SparkSession, source: str, partition_col: str) -> DataFrame:
    """The source's files now, in the ledger's columns."""
    value = F.regexp_extract("file_path", f"/{partition_col}=([^/]*)/", 1)
    return list_files(spark, [source]).select("file_path", "bytes", F.url_decode(value).alias(partition_col))


def pending_partitions(files: DataFrame, ledger: DataFrame, partition_col: str) -> list[str]:
    """Partitions whose files differ from those that the ledger has."""
    same = ["file_path", "bytes"]
    changed = files.join(ledger, same, "left_anti").unionByName(ledger.join(files, same, "left_anti"))
    return sorted(r[0] for r in changed.select(partition_col).distinct().collect())


def _drop_partitions(spark: SparkSession, path: str, partition_col: str, values: list[str]) -> None:
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def load_partitions(
    spark: SparkSession,
    source: str,
    target: str,
    ledger_path: str,
    partition_col: str,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    sort_cols: tuple[str, ...] = (),
) -> DataFrame:
    """Bring ``target`` up to date with ``source``.  Returns ``(<partition>,
    files, rows)`` of every partition that this call loaded; 0 files for one
    that the source has no more, and no row when nothing has changed.
    ``transform`` keeps the partition column, and is given whole partitions."""
    source, target, ledger_path = (p.rstrip("/") for p in (source, target, ledger_path))
    files = source_files(spark, source, partition_col)
    ledger = read_ledger(spark, ledger_path, partition_col)
    pending = pending_partitions(files, ledger, partition_col)
    empty = spark.createDataFrame([], f"{partition_col} string, files bigint, rows bigint")
    if not pending:
        return empty
    # at most one value a partition; the ledger's rows to come, before anything is written
    chosen = F.col(partition_col).isin(pending)
    listed = files.filter(chosen).collect()
    rows = read_partitioned(spark, source, partition_col).filter(chosen)
    write_partitioned(transform(rows), target, partition_col, sort_cols, only_partitions=True)
    here = {r[partition_col] for r in listed}
    gone = [value for value in pending if value not in here]
    _drop_partitions(spark, target, partition_col, gone)
    _drop_partitions(spark, ledger_path, partition_col, gone)
    entries = spark.createDataFrame(listed, f"{LEDGER_COLUMNS}, {partition_col} string")
    write_partitioned(entries, ledger_path, partition_col, ("file_path",), only_partitions=True)
    # counted from what is stored now
    stored = read_partitioned(spark, target, partition_col).filter(chosen).groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows"))
    counts = spark.createDataFrame([(v, sum(r[partition_col] == v for r in listed)) for v in pending], f"{partition_col} string, files bigint")
    loaded = counts.join(stored, partition_col, "left")
    return loaded.select(partition_col, "files", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


def rows_loaded(loaded: DataFrame) -> int:
    """Rows that one load wrote."""
    return int(loaded.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
