"""Drift-tolerant multi-file reader.

Monthly files drift: an int column becomes long, a column is missing, a
name changes case.  Reading all files as one path fails on a physical type
conflict, and reading each file separately makes an N-way union.  Instead a
Spark job reads all footers and groups the files by the canonical columns that
they hold and the types they hold them in; each group is read with ONE scan,
cast to the canonical schema, and the few groups are unioned by name.  Missing
columns become typed NULLs and are reported as drift rows.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tripline.functions import fill
from tripline.sources.footers import footers

Canonical = list[tuple[str, DataType]]
Aliases = dict[str, tuple[str, ...]] | None

# Fixed value: text of a drift message.
DRIFT_MESSAGE = "{file}: missing column '{column}' (filled null)"


@dataclass(frozen=True)
class SchemaGroup:
    """Files of one schema; ``held`` names the column of the files that each
    canonical column comes from, None where they have none."""

    paths: list[str]
    held: dict[str, str | None]


def _spellings(canonical: Canonical, aliases: Aliases) -> dict[str, tuple[str, ...]]:
    return {name: (name, *(aliases or {}).get(name, ())) for name, _ in canonical}


def _held(spelled: tuple[str, ...]) -> Column:
    """The first of some spellings that a file's footer has, with its type; NULL where it has none."""
    def of(spelling: str) -> Column:
        return F.filter("columns", lambda c: c["name"] == spelling)

    found = F.flatten(F.array(*map(of, spelled)))
    return F.get(F.transform(found, lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"))), F.lit(0))


def schema_groups(spark: SparkSession, paths: list[str], canonical: Canonical, aliases: Aliases) -> list[SchemaGroup]:
    """The files under ``paths``, each once, by what they hold of the canonical
    columns, merged in one aggregate over their footers: a row for each group."""
    if not paths:
        raise ValueError("no input files")
    spellings = _spellings(canonical, aliases)
    found = footers(spark, paths).select("file_path", F.array(*map(_held, spellings.values())).alias("held"))
    merged = found.groupBy("held").agg(F.array_sort(F.collect_list("file_path")).alias("paths")).collect()
    groups = [SchemaGroup(r.paths, {n: h and h["name"] for n, h in zip(spellings, r.held)}) for r in merged]
    return sorted(groups, key=lambda g: g.paths[0])


def read_aligned(
    spark: SparkSession, paths: list[str], canonical: Canonical, aliases: Aliases = None
) -> DataFrame:
    """Read ``paths`` into one DataFrame with the canonical schema, one scan
    for each schema among them.  A column that a file lacks is NULL, extra
    columns are dropped, and a value that does not fit its canonical type
    becomes NULL (``failed_values`` counts them)."""
    types = dict(canonical)

    def aligned(group: SchemaGroup) -> DataFrame:
        return spark.read.parquet(*group.paths).select(*[
            (F.lit(None) if column is None else F.col(column)).try_cast(types[name]).alias(name)
            for name, column in group.held.items()
        ])

    return functools.reduce(
        DataFrame.unionByName, map(aligned, schema_groups(spark, paths, canonical, aliases))
    )


def drift_frame(
    spark: SparkSession, paths: list[str], canonical: Canonical, aliases: Aliases = None
) -> DataFrame:
    """``(file_name, column_name)`` for every canonical column that a file
    lacks, empty files too, from the job that reads the footers."""
    if not paths:
        raise ValueError("no input files")
    lacking = [F.when(_held(spelled).isNull(), F.lit(name)) for name, spelled in _spellings(canonical, aliases).items()]
    found = footers(spark, paths).select("file_name", F.explode(F.array_compact(F.array(*lacking))).alias("column_name"))
    # files x missing columns, never rows: plans that join it stay free of Python
    return spark.createDataFrame(found.collect(), "file_name string, column_name string")


def failed_values(
    spark: SparkSession, paths: list[str], canonical: Canonical, aliases: Aliases = None
) -> DataFrame:
    """``(file_name, column_name, failed)``: values that a file holds and the
    canonical type does not, one pass over the files; only columns with any."""
    types = dict(canonical)

    def counted(group: SchemaGroup) -> DataFrame:
        counts = [
            F.struct(
                F.lit(name).alias("column_name"),
                F.count_if(F.col(column).isNotNull() & F.col(column).try_cast(types[name]).isNull()).alias("failed"),
            )
            for name, column in group.held.items() if column is not None
        ]
        files = spark.read.parquet(*group.paths).groupBy(F.col("_metadata.file_name").alias("file_name"))
        return files.agg(F.array(*counts).alias("found")).select("file_name", F.inline("found"))

    groups = [g for g in schema_groups(spark, paths, canonical, aliases) if any(g.held.values())]
    if not groups:
        return spark.createDataFrame([], "file_name string, column_name string, failed bigint")
    return functools.reduce(DataFrame.unionByName, map(counted, groups)).filter("failed > 0")


def drift_messages(drift: DataFrame) -> DataFrame:
    """Drift rows as one text column, ``message``."""
    text = fill(DRIFT_MESSAGE, file=F.col("file_name"), column=F.col("column_name"))
    return drift.select(text.alias("message"))
