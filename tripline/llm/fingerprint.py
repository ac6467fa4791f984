"""Document fingerprints: every word-shingle hash below a fixed fraction of the hash range.

All texts keep the hashes below one half (``SCALE``) of the range, whatever their length, so any two sketches
stand for the same part of it.  The sketch of a union is the union of sketches, so sketches merge, and the
share of common hashes estimates Jaccard similarity and, for documents of very unequal length, containment.
A text of n shingles has none of them in its sketch with probability 2**-n.

Neighbours: rows are dealt to ranges of (doc_id, text hash), ``RANGES`` for each shuffle partition, with
bounds from a hash-drawn sample of keys (``SAMPLE`` for each range, about), as a range partitioner draws
them.  A range also gets the first row of the next one, so each text crosses the network once, and no table
of the driver or of a broadcast grows with the rows.  Equal rows are counted where they are read, in each
batch, so that copies of one row do not meet in one task.

Defined cases: null text counts as empty; a text without words has an empty fingerprint; two sketches
without hashes are alike to 1 when the texts are equal and 0 otherwise; equal texts have equal fingerprints;
texts of any length are read whole, one at a time when long; an empty table gives no rows; columns but
doc_id and text, whatever their names, are not read.  Rows are ordered by doc_id (null last), then text
hash; repeated rows follow one another.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import SLICE_BYTES, shingle_sets, table, text_batches, text_slices

SHINGLE = 5
#: One shingle hash of so many is retained.
SCALE = 2
#: Ranges of consecutive rows for each shuffle partition, and keys drawn for each range.
RANGES, SAMPLE = 4, 16


def sketches(texts: list[str], scale: int = SCALE, k: int = SHINGLE) -> list[np.ndarray]:
    """The retained 32-bit hashes of each text, ascending."""
    out = []
    for _, _, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        rows, hashes, _ = shingle_sets(data, offsets, k)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        if scale > 1:
            keep = short < np.uint32((1 << 32) // scale)
            rows, short = rows[keep], short[keep]
        ends = np.searchsorted(rows, np.arange(len(offsets)))
        out += [np.unique(short[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return out


def to_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    return np.union1d(a, b)


def common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def jaccard(a: np.ndarray, b: np.ndarray, equal: bool = False) -> float:
    both = common(a, b)
    union = len(a) + len(b) - both
    return both / union if union else float(equal)


def containment(a: np.ndarray, b: np.ndarray, equal: bool = False) -> float:
    """Share of the smaller sketch that the larger one holds."""
    least = min(len(a), len(b))
    return common(a, b) / least if least else float(equal)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _key(doc_id: int | None, thash: int) -> tuple[bool, int, int]:
    """Place of a row among all: null ids last, then by text hash."""
    return doc_id is None, doc_id or 0, thash


def _bounds(keys: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """The least keys of all ranges but the first, from a sample that ``ranges`` bounds."""
    one_of = max(1, keys.count() // (ranges * SAMPLE))
    drawn = keys.where(F.pmod(F.xxhash64("doc_id", "thash"), F.lit(one_of)) == 0).distinct().collect()
    drawn = sorted(_key(r.doc_id, r.thash) for r in drawn)
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []


def _with_next(documents: DataFrame, ranges: int) -> DataFrame:
    """Rows (range, tail, doc_id, text, thash, copies) in partitions sorted so that every row's successor follows it.

    A range ends with a tail row: the first row of the next range that has any (of the first range, after
    the last), which is read but gives no result.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("thash", F.xxhash64("text"))
    keys = docs.select("doc_id", "thash")
    bounds = _bounds(keys, ranges)

    def deal(batches):
        for batch in batches:
            rows = [_key(i, h) for i, h in zip(batch.column("doc_id").to_pylist(), batch.column("thash").to_pylist())]
            copies, at = Counter(rows), {}
            for i, row in enumerate(rows):
                at.setdefault(row, i)
            some = batch.take(pa.array(list(at.values()), pa.int64()))
            where = pa.array([bisect.bisect_right(bounds, row) for row in at], pa.int64())
            counts = pa.array([copies[row] for row in at], pa.int64())
            yield pa.RecordBatch.from_arrays([where, *some.columns, counts], names=["range", *some.schema.names, "copies"])

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "thash")).alias("first")
    heads = keys.mapInArrow(deal, "range long, doc_id long, thash long, copies long").groupBy("range").agg(first).collect()  # a row for each range
    order = sorted(r.range for r in heads)
    before = dict(zip(order[1:] + order[:1], order))
    heads = spark.createDataFrame([(before[r.range], r.first.doc_id, r.first.thash) for r in heads], "range long, h_id long, h_thash long")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("thash") == F.col("h_thash"))
    none = F.lit(0).cast("long").alias("copies")
    tails = docs.join(F.broadcast(heads), same).dropDuplicates(["range"]).select("range", F.lit(1).alias("tail"), "doc_id", "text", "thash", none)
    own = docs.mapInArrow(deal, "range long, doc_id long, text string, thash long, copies long")
    both = own.select("range", F.lit(0).alias("tail"), "doc_id", "text", "thash", "copies").unionByName(tails)
    return both.repartition("range").sortWithinPartitions("range", "tail", F.col("doc_id").asc_nulls_last(), "thash")


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, contained_next double"
)


def _pairs(rows: list[list], scale: int) -> pa.RecordBatch:
    """Results for all but the last of some consecutive rows [tail, doc_id, text, thash, copies]; a row's copies follow one another."""
    texts, nexts, owners = [r[2] for r in rows], [], []
    for i, row in enumerate(rows[:-1]):
        for j, times in ((i, row[4] - 1), (i + 1, 1)):
            if times and not row[0]:
                nexts.append((i, j))
                owners.append(times)
    edits = [edited(texts[i], texts[j]) for i, j in nexts]
    own, other = sketches(texts, scale), sketches(edits, scale)
    out = []
    for (i, j), times, text, sketch in zip(nexts, owners, edits, other):
        result = (
            rows[i][1],
            len(texts[i]),
            hashlib.sha256(text.encode()).hexdigest(),
            to_text(own[i]),
            to_text(sketch),
            jaccard(own[i], sketch, texts[i] == text),
            jaccard(own[i], own[j], texts[i] == texts[j]),
            containment(own[i], sketch, texts[i] == text),
            containment(own[i], own[j], texts[i] == texts[j]),
        )
        out += [result] * times
    columns = list(zip(*out)) if out else [[] for _ in range(9)]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def fingerprint_documents(documents: DataFrame, scale: int = SCALE, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's start, and their likeness."""

    def run(batches):
        held: list[list] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("tail", "doc_id", "text", "thash", "copies"))):
                if held and held[-1][:2] == [row[0], row[1]] and held[-1][3] == row[3]:
                    held[-1][4] += row[4]  # the copies that another batch held
                    continue
                held.append(list(row))
                size += len(row[2])
                if size >= SLICE_BYTES and len(held) > 2:
                    # copies of the last row may follow
                    yield _pairs(held[:-1], scale)
                    held, size = held[-2:], sum(len(r[2]) for r in held[-2:])
        if len(held) > 1:
            yield _pairs(held, scale)

    if documents.isEmpty():
        return documents.sparkSession.createDataFrame([], _SCHEMA)
    ranges = ranges or RANGES * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _with_next(text_batches(documents), ranges).select("tail", "doc_id", "text", "thash", "copies").mapInArrow(run, _SCHEMA)


def op9_scaled_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
