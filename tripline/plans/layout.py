"""Clustered, two-column-clustered and plain layouts, partition-pruning helper
and scan metrics."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.functions import exact_avg, exact_sum
from tripline.model import TripModel
from tripline.plans import scanlog
from tripline.sources.files import write_partitioned

PARTITION_COL = "year_month"
DAY_COL = "pickup_date"


def write_clustered(trips: DataFrame, path: str, model: TripModel,
                    partition_col: str = PARTITION_COL) -> None:
    """Month (default) or day partitions, rows clustered by (origin zone,
    payment type) and date inside each file: partition pruning on the
    partition column, row-group skipping on zone and date.  Day partitions
    suit very large inputs; months keep file counts sane on small ones."""
    sort = (model.origin, model.payment) + (() if partition_col == DAY_COL else (DAY_COL,))
    write_partitioned(trips, path, partition_col, sort)


# Bits of each column in the key of the two-column layout, and its row groups.
INTERLEAVED_BITS = 10
ROW_GROUP_BYTES = 16 * 1024**2


def interleaved(x: Column, y: Column, bits: int = INTERLEAVED_BITS) -> Column:
    """The bits of two whole numbers in turn, x's lowest bit last: rows near in
    both columns are near in this key (a Z-order curve)."""
    key = F.lit(0).cast("bigint")
    for i in range(bits):
        for place, c in ((2 * i, x), (2 * i + 1, y)):
            bit = F.shiftright(c.cast("bigint"), i).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, place))
    return key


def _spread(c: Column, low, high, bits: int) -> Column:
    """A value's place between the least and greatest one, in ``bits`` bits; NULL comes first."""
    place = F.floor((c - F.lit(low)).cast("double") * (2**bits - 1) / F.lit(float(max(high - low, 1))))
    return F.coalesce(place, F.lit(0)).cast("bigint")


def write_interleaved(trips: DataFrame, path: str, model: TripModel, files: int | None = None,
                      row_group_bytes: int = ROW_GROUP_BYTES, bits: int = INTERLEAVED_BITS) -> None:
    """One layout for filters on the origin zone, on the date, or on both: rows
    are range-partitioned and sorted by the interleaved bits of zone and date,
    so every file and row group holds a small range of each, and the zone has
    Parquet bloom filters besides.  The bounds come from one aggregate."""
    day = F.datediff(DAY_COL, F.lit("1970-01-01").cast("date"))
    zone = F.col(model.origin).cast("bigint")
    ends = trips.agg(F.min(zone), F.max(zone), F.min(day), F.max(day)).first()
    if ends[0] is None or ends[2] is None:
        return write_plain(trips, path)
    key = interleaved(_spread(zone, ends[0], ends[1], bits), _spread(day, ends[2], ends[3], bits), bits)
    keyed = trips.withColumn("__key", key)
    dealt = keyed.repartitionByRange(files, "__key") if files else keyed.repartitionByRange("__key")
    (
        dealt.sortWithinPartitions("__key", model.origin, DAY_COL).drop("__key")
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option(f"parquet.bloom.filter.enabled#{model.origin}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{model.origin}", 4096)
        .parquet(path)
    )


def write_plain(trips: DataFrame, path: str) -> None:
    trips.write.mode("overwrite").parquet(path)


def date_range_filter(start: str, end: str, date_col: str = DAY_COL,
                      partition_col: str | None = PARTITION_COL) -> Column:
    """``date BETWEEN start AND end`` plus the implied month-partition range,
    so a filter on the derived date also prunes month partitions.  With day
    partitions the date filter prunes by itself."""
    cond = F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    if partition_col and partition_col != date_col:
        cond = cond & F.col(partition_col).between(start[:7], end[:7])
    return cond


def zone_period_query(table: DataFrame, model: TripModel, zone: int, start: str, end: str,
                      partition_col: str | None = PARTITION_COL) -> DataFrame:
    """Revenue and trips per day for one pickup zone over a date range."""
    has_part = partition_col is not None and partition_col in table.columns
    cond = date_range_filter(start, end, partition_col=partition_col if has_part else None)
    return (
        table.filter(cond & (F.col(model.origin) == zone))
        .groupBy(F.col("pickup_date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.round(exact_sum(table, model.total), 2).cast("double").alias("revenue"),
            F.round(exact_avg(table, model.distance), 3).alias("avg_distance"),
        )
    )


def scan_metrics(df: DataFrame) -> dict:
    """Files and bytes the scans of ``df`` read, from the executed plan's
    scan-node metrics (run it first).  Needs a classic (non-Connect) session."""
    files = size = 0
    plan = df._jdf.queryExecution().executedPlan()

    def visit(node):
        nonlocal files, size
        name = node.nodeName()
        if "Scan" in name:
            metrics = node.metrics()
            if metrics.contains("numFiles"):
                files += metrics.apply("numFiles").value()
            if metrics.contains("filesSize"):
                size += metrics.apply("filesSize").value()
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return {"files": int(files), "bytes": int(size)}


def benchmark(spark: SparkSession, clustered_path: str, plain_path: str, model: TripModel,
              zone: int, start: str, end: str, partition_col: str = PARTITION_COL) -> DataFrame:
    """Same query on both copies: bytes and wall seconds, reduction and
    speed-up, as a one-row DataFrame.  ``*_bytes`` is the size of the opened
    files, ``*_bytes_read`` what their tasks read, from the event log, which the
    reduction uses; NULL in a session without one (then the size is used).
    Both copies are read once before they are timed.  AQE is off in a session of its own, so scan metrics come
    from a static plan and the caller's settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    runs = {
        "clustered": zone_period_query(own.read.parquet(clustered_path), model, zone, start, end, partition_col),
        "naive": zone_period_query(own.read.parquet(plain_path), model, zone, start, end, None),
    }
    for q in runs.values():
        q.write.format("noop").mode("overwrite").save()
    out, groups = {}, {}
    for label, q in runs.items():
        with scanlog.job_group(spark, f"layout-{label}") as groups[label]:
            t0 = time.perf_counter()
            q.collect()
            out[label] = (time.perf_counter() - t0, scan_metrics(q))
    read = scanlog.input_of(spark, list(groups.values()))
    row = {}
    for label, (seconds, opened) in out.items():
        row |= {
            f"{label}_bytes": opened["bytes"],
            f"{label}_files": opened["files"],
            f"{label}_bytes_read": read[groups[label]][0] if read else None,
            f"{label}_seconds": round(seconds, 3),
        }
    row = spark.createDataFrame([row], ", ".join(f"{c} {'double' if c.endswith('seconds') else 'bigint'}" for c in row))
    scanned = {c: F.coalesce(f"{c}_bytes_read", f"{c}_bytes") for c in runs}
    return row.select(
        *row.columns,
        F.round((1 - F.try_divide(scanned["clustered"], scanned["naive"])) * 100, 2).alias("bytes_scanned_reduction_pct"),
        F.round(F.try_divide(F.col("naive_seconds"), F.col("clustered_seconds")), 2)
        .alias("wall_clock_speedup_x"),
    )
