"""Parquet footers, read by a Spark job: schema, rows and column sizes of files without their data."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.sources.files import list_files

COLUMN = "struct<name:string,type:string,bytes:bigint>"
FOOTER_SCHEMA = f"file_path string, file_name string, bytes bigint, rows bigint, columns array<{COLUMN}>"
# Schemes of Hadoop's connectors that tasks open by another name.
OPENED_AS = {"s3a": "s3", "s3n": "s3"}


def _metadata(uri: str):
    """The footer of one file, from its last bytes."""
    scheme, rest = uri.split(":", 1)
    rest = rest if rest.startswith("//") else f"//{rest}"
    system, name = pafs.FileSystem.from_uri(f"{OPENED_AS.get(scheme, scheme)}:{rest}")
    with system.open_input_file(name) as file:
        return pq.read_metadata(file)


def _described(metadata) -> tuple[int, list[dict]]:
    """Rows of a file, and name, type and stored bytes of its top-level columns."""
    schema = metadata.schema.to_arrow_schema()
    sizes = dict.fromkeys(schema.names, 0)
    for group in map(metadata.row_group, range(metadata.num_row_groups)):
        for chunk in map(group.column, range(group.num_columns)):
            name = chunk.path_in_schema
            top = name if name in sizes else name.split(".")[0]
            sizes[top] = sizes.get(top, 0) + chunk.total_compressed_size
    return metadata.num_rows, [{"name": f.name, "type": str(f.type), "bytes": sizes[f.name]} for f in schema]


def tasks_can_open(uri: str) -> bool:
    """Whether a file's store is one that tasks read without Hadoop's connectors."""
    try:
        _metadata(uri)
    except (pa.ArrowInvalid, OSError, ImportError):
        return False
    return True


def footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file_path, file_name, bytes, rows, columns)`` of every Parquet file
    under ``paths``, empty files too.  Files are listed and their footers read
    in tasks, whatever their number; ``columns`` has name, type and stored
    bytes of each.  Stores that only Hadoop's connectors reach are asked file
    by file from the driver, for schemas alone (``rows`` and sizes NULL)."""
    listed = list_files(spark, paths)
    probe = listed.limit(1).collect()
    if probe and not tasks_can_open(probe[0].file_path):
        return _footers_through_spark(spark, listed)

    def read(batches):
        for batch in batches:
            found = [_described(_metadata(uri)) for uri in batch.column("file_path").to_pylist()]
            rows = pa.array([n for n, _ in found], pa.int64())
            kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string()), ("bytes", pa.int64())]))
            columns = [*batch.columns, rows, pa.array([c for _, c in found], kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["file_path", "file_name", "bytes", "rows", "columns"])

    return listed.mapInArrow(read, FOOTER_SCHEMA)


def _footers_through_spark(spark: SparkSession, listed: DataFrame) -> DataFrame:
    rows = []
    for file in listed.collect():
        schema = spark.read.parquet(file.file_path).schema
        columns = [(f.name, f.dataType.simpleString(), None) for f in schema]
        rows.append((file.file_path, file.file_name, file.bytes, None, columns))
    return spark.createDataFrame(rows, FOOTER_SCHEMA)


def column_bytes(found: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``(column_name, files, bytes)``: what the files store of each column."""
    each = found.select(F.explode("columns").alias("c")).select("c.*")
    each = each.filter(F.col("name").isin(names)) if names is not None else each
    return each.groupBy(F.col("name").alias("column_name")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
