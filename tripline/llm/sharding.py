"""Sharding by a keyed permutation of global row numbers.

Rows get gapless numbers 0..n-1 from their values alone: a fixed number of hash buckets, the order
inside a bucket, and the buckets' cumulative counts.  A Feistel network over the smallest even-width
power of two that holds n, walked along its cycle until it lands below n, permutes the numbers.
Position p goes to shard ``p mod shards``, slot ``p div shards``: shard and slot follow from (row
number, n, seed) by arithmetic, and ``row_at`` inverts them.  Shard sizes differ by one row at most.

Defined cases: identical rows are interchangeable and each gets a place of its own; null in any column
is a value like any other; an empty table gives no rows; input columns named like the added ones
(``row_number``, ``shard``, ``slot``) are replaced.  Columns of map type are not supported.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tripline.llm.common import mix, table

ROUNDS = 6
#: Row numbers are dealt from so many hash buckets; bounds the table of cumulative counts.
BUCKETS = 8192


def _round_keys(seed: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _feistel(x: np.ndarray, half: int, keys: np.ndarray, inverse: bool = False) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & low
    for key in keys[::-1] if inverse else keys:
        if inverse:
            left, right = right ^ (mix(left ^ key) & low), left
        else:
            left, right = right, left ^ (mix(right ^ key) & low)
    return (left << np.uint64(half)) | right


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 at ``numbers``: encrypt again while the result is n or more."""
    keys, half = _round_keys(seed), _half_bits(n)
    out = _feistel(np.asarray(numbers).astype(np.uint64), half, keys, inverse)
    while (far := np.flatnonzero(out >= np.uint64(n))).size:
        out[far] = _feistel(out[far], half, keys, inverse)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The row number that lies at a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def number_rows(df: DataFrame) -> DataFrame:
    """``df`` with ``row_number`` (0..n-1, by values) and ``row_total``; equal rows are counted before they are shuffled."""
    names = df.columns
    keyed = (
        df.groupBy(*names)
        .agg(F.count("*").alias("__copies"))
        .withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(BUCKETS)))
    )
    sizes = df.groupBy(F.pmod(F.xxhash64(*names), F.lit(BUCKETS)).alias("__bucket")).agg(F.count("*").alias("__rows"))
    running = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select(
        "__bucket",
        (F.sum("__rows").over(running) - F.col("__rows")).alias("__start"),
        F.sum("__rows").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("row_total"),
    )
    inside = Window.partitionBy("__bucket").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("__before", F.sum("__copies").over(inside) - F.col("__copies"))
    # at most BUCKETS rows of three numbers
    return (
        placed.join(F.broadcast(starts), "__bucket")
        .select(
            *names,
            "row_total",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)).alias("__copy"),
            (F.col("__start") + F.col("__before")).alias("__first"),
        )
        .select(*names, "row_total", (F.col("__first") + F.col("__copy")).alias("row_number"))
    )


def shard_rows(df: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """``df`` with row_number, shard and slot."""
    df = df.drop("row_number", "row_total", "shard", "slot")

    @F.pandas_udf(LongType())
    def position(number: pd.Series, total: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), int(total.iloc[0]), seed) if len(number) else number)

    at = number_rows(df).withColumn("__at", position("row_number", "row_total"))
    return at.select(
        *df.columns,
        "row_number",
        (F.col("__at") % shards).cast("int").alias("shard"),
        F.floor(F.col("__at") / shards).cast("long").alias("slot"),
    )


def shard_documents(documents: DataFrame, shards: int = 8, seed: int = 1) -> DataFrame:
    """Shard and slot of every document, with the size and checksum of its text; law ``rows``."""
    rows = documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard_rows(rows, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op1_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
