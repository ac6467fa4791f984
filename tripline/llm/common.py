"""Helpers shared by the operators: table access, scratch tables, text batches, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step handles; bounds a worker's temporaries.
SLICE_BYTES = 1 << 20
#: Bytes of rows that Spark sends to a worker at once, unless one row has more.
BATCH_BYTES = 4 << 20
#: The separators between words.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tripline-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches held to BATCH_BYTES, so that long texts do not add up in a worker."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit words (a bijection, so distinct inputs stay distinct)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a whole string column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows; a slice passes ``most`` bytes only for one long text."""
    if not len(column):
        return
    data, offsets = text_column(column)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, for positions below n."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, SLICE_BYTES + 1024)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


class RangeHash:
    """Hashes of arbitrary byte ranges of one buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lower-cased), and the row of each word."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = _LOWER[data]
    word = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[offsets <= len(data)]] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = ~word[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = ~word[1:]
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    return RangeHash(low)(starts, ends), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes by row: (row, hash) sorted by both, and the number of words of each row.

    A row with fewer than k words has its whole sequence as one shingle, a row without words none.
    """
    words, rows = word_hashes(data, offsets)
    n_rows = len(offsets) - 1
    counts = np.bincount(rows, minlength=n_rows)
    firsts = np.cumsum(counts) - counts
    hashes, owners = [], []
    if len(words) >= k:
        h = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            h = mix(h + words[j : len(words) - k + 1 + j])
        whole = rows[: len(h)] == rows[k - 1 :]
        hashes.append(h[whole])
        owners.append(rows[: len(h)][whole])
    for row in np.flatnonzero((counts > 0) & (counts < k)):
        h = np.zeros(1, np.uint64)
        for w in words[firsts[row] : firsts[row] + counts[row]]:
            h = mix(h + w)
        hashes.append(h ^ np.uint64(counts[row]))
        owners.append(np.array([row]))
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), counts
    h, o = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return o[new], h[new], counts


def segment_sums(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    """Sum of values by owner (sorted), modulo 2**64 for unsigned values."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    ends = np.searchsorted(owners, np.arange(n + 1))
    return total[ends[1:]] - total[ends[:-1]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over undirected edges (a, b), by large-star and small-star rounds.

    Every round is a shuffle and a grouped minimum; a node's neighbours are never gathered in one
    row.  Nodes without an edge to another node are not returned.  Rounds end when the links stop changing.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )

    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both if large else links
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = near.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return out.where("u <> v").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(links)
    while seen[0]:
        links = stored(star(star(links, True), False), name)
        now = mark(links)
        if now == seen:
            break
        seen = now
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
