"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes when a ``length``-byte string that covers it also starts anywhere else.  Instead of every
suffix, only strings that may still be equal stay in a bucket:

1. Initial buckets: hashes of all q-grams, q = length / 16.  Each window of ``length`` bytes is put in the
   bucket of its least q-gram; consecutive windows with one least q-gram form a run, so buckets hold
   runs (a few per ``length`` bytes), not positions.
2. Refinement: the bucket id of 2k bytes at a position is made of the ids of k bytes there and k bytes
   later, recursively; runs split in two, and each half goes to the bucket of a string that all its
   windows share.  Buckets of one place are dropped.  Runs whose whole content occurs at another place
   are settled.
3. What is left, the ends of matches, is split into ever shorter pieces in the same way (``PIECES``
   windows each), down to single windows, whose bucket id is that of all ``length`` bytes.

Texts are identified by hash and judged once: a text that occurs twice is repeated as a whole.  Strings
are compared by 64-bit ids.

Defined cases: null text counts as empty; texts shorter than ``length`` lose nothing; matches never cross
rows; repeated rows are other places, so they lose all of a text of ``length`` bytes or more; an empty
table gives no rows; a very long text is one slice of a batch and judged whole; columns but doc_id and text
are not read, so their names may be those of results.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import RangeHash, mix, stored, table, text_batches, text_slices

LENGTH = 400
PIECES = (24, 1)
#: Keys that a broadcast may hold.
HOT_KEYS = 4096
_MULT = np.uint64(0x2545F4914F6CDD1D)


class Buckets:
    """Bucket ids of strings of one buffer: q-grams by hash, longer strings by the ids at two offsets."""

    def __init__(self, data: np.ndarray, q: int):
        self.q, self.size = q, len(data)
        self.hash = RangeHash(data)
        at = np.arange(max(len(data) - q + 1, 0))
        self.grams = self.hash(at, at + q)

    def __call__(self, at: np.ndarray, k: int) -> np.ndarray:
        if k == self.q:
            return self.grams[at]
        half = max((k + 1) // 2, self.q)
        return mix(self(at, half) * _MULT + self(at + (k - half), half))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values)
    full = -(-n // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Half runs of the windows of each row: bucket key, content id, row, first window, windows, least q-gram (from the row's start)."""
    q = max(1, length // 16)
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 4))
    if len(data) < length:
        return none
    buckets = Buckets(data, q)
    width = length - q + 1
    low = np.uint64(0xFFFFFFFF)
    at = np.arange(len(buckets.grams), dtype=np.uint64)
    least = _sliding_least((buckets.grams & ~low) | at, width)
    anchor = (least & low).astype(np.int64)
    starts = np.arange(len(least))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = starts + length <= offsets[rows + 1]
    starts, rows, anchor = starts[inside], rows[inside], anchor[inside]
    if not len(starts):
        return none
    half = (width + 1) // 2
    far = anchor - starts >= half
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (far[1:] != far[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    a, row, far, anchor = starts[first], rows[first], far[first], anchor[first]
    shared = anchor - np.where(far, half, 0)  # a string from here lies in every window of the half run
    key = mix(buckets(shared, max(length - half, q)) + far.astype(np.uint64))
    content = mix(buckets.hash(a, a + count - 1 + length) + count.astype(np.uint64))
    return key, content, row, a - offsets[row], count, anchor - offsets[row]


def split_runs(data: np.ndarray, runs: list[tuple[int, int, int]], length: int, piece: int, buckets: Buckets) -> tuple[np.ndarray, ...]:
    """Pieces of runs (first window, windows, least q-gram) of one text: bucket key, content id, first window, windows, least q-gram.

    Pieces are cut by the distance to the q-gram, so equal windows fall in equal pieces.
    """
    starts = np.concatenate([np.arange(a, a + n) for a, n, _ in runs])
    anchor = np.repeat([x for _, _, x in runs], [n for _, n, _ in runs])
    run = np.repeat(np.arange(len(runs)), [n for _, n, _ in runs])
    part = (anchor - starts) // piece
    new = np.ones(len(starts), bool)
    new[1:] = (part[1:] != part[:-1]) | (run[1:] != run[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    a, anchor, part = starts[first], anchor[first], part[first]
    key = mix(buckets(anchor - part * piece, length - piece + 1) + part.astype(np.uint64))
    content = mix(buckets.hash(a, a + count - 1 + length) + count.astype(np.uint64))
    return key, content, a, count, anchor


def _place(tid: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(tid.view(np.uint64) * _MULT + at.astype(np.uint64)).view(np.int64)


_RUNS = "key long, content long, place long, tid long, start int, windows int, anchor int"


def _batch(key, content, tid, start, windows, anchor) -> pa.RecordBatch:
    columns = (key.view(np.int64), content.view(np.int64), _place(tid, start), tid, *(x.astype(np.int32) for x in (start, windows, anchor)))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in _RUNS.split(", ")])


def _runs(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            tids = batch.column("tid").to_numpy()
            for first, _, data, offsets in text_slices(batch.column("text")):
                key, content, row, *places = window_runs(data, offsets, length)
                yield _batch(key, content, tids[first:][row], *places)

    return texts.mapInArrow(run, _RUNS)


def _split(texts: DataFrame, length: int, piece: int) -> DataFrame:
    """The runs listed with each text (tid, text, runs), in pieces."""

    def run(batches):
        q = max(1, length // 16)
        for batch in batches:
            tids, runs = batch.column("tid").to_numpy(), batch.column("runs").to_pylist()
            for first, end, data, offsets in text_slices(batch.column("text")):
                for row in range(first, end):
                    text = data[offsets[row - first] : offsets[row - first + 1]]
                    listed = sorted({(r["start"], r["windows"], r["anchor"]) for r in runs[row]})
                    key, content, *places = split_runs(text, listed, length, piece, Buckets(text, q))
                    yield _batch(key, content, np.full(len(key), tids[row]), *places)

    return texts.select("tid", "text", "runs").mapInArrow(run, _RUNS)


def _flagged(rows: DataFrame, key: str, flag: str, of_key: Column) -> DataFrame:
    """The rows with a boolean column, an aggregate over all rows of their key.

    Keys with more than one in HOT_KEYS of the rows, fewer than HOT_KEYS whatever the input, are sent to the
    rows where they lie; the rows of the others meet their keys in a shuffle.  So no task gets a large group.
    """
    most = max(1, rows.count() // HOT_KEYS)
    keys = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), of_key.alias(flag))
    hot = rows.join(F.broadcast(keys.where(F.col("n") > most).select(key, flag)), key, "left")
    cold = keys.where((F.col("n") <= most) & F.col(flag)).select(key, flag)
    rest = hot.where(F.col(flag).isNull()).drop(flag).join(cold, key, "left")
    return hot.where(F.col(flag).isNotNull()).unionByName(rest.withColumn(flag, F.coalesce(flag, F.lit(False))))


def _repeated(runs: DataFrame) -> DataFrame:
    """The runs whose bucket holds two places or more."""
    found = _flagged(runs, "key", "repeated", F.min("place") != F.max("place"))
    return found.where("repeated").select(*runs.columns)


def _texts(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tid"))


def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(tid, spans): byte ranges [start, end) of each distinct text that a repeated string covers; they may overlap."""
    texts = _texts(text_batches(documents))
    long = texts.where(F.octet_length("text") >= length)
    runs = stored(_runs(long.select("tid", "text"), length), "suffix-buckets")
    size, spans, held = F.lit(length), None, None
    for piece in (min(p, max(1, length // 16)) for p in PIECES):
        runs = stored(_repeated(runs).distinct(), "suffix-runs")
        runs = stored(_flagged(runs, "content", "settled", F.min("place") != F.max("place")), "suffix-marked")
        found = runs.where("settled").select("tid", "start", (F.col("start") + F.col("windows") - 1 + size).alias("end"))
        spans = found if spans is None else spans.unionByName(found)
        # one place for each content is enough to find its windows elsewhere
        place = F.min(F.struct("place", "tid", "start", "windows", "anchor")).alias("r")
        to_open = _flagged(runs, "key", "open", F.bool_or(~F.col("settled"))).where("open").groupBy("content").agg(place)
        lists = to_open.groupBy(F.col("r.tid").alias("tid")).agg(F.collect_set(F.struct("r.start", "r.windows", "r.anchor")).alias("runs"))
        held = stored((long if held is None else held).select("tid", "text").join(lists, "tid").dropDuplicates(["tid"]), "suffix-texts")
        runs = stored(_split(held, length, piece), "suffix-pieces")
    spans = spans.unionByName(_repeated(runs).select("tid", "start", (F.col("start") + size).alias("end")))
    spans = spans.unionByName(
        long.groupBy("tid", F.octet_length("text").alias("end")).count().where("count > 1").select("tid", F.lit(0).alias("start"), "end")
    )
    return spans.groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, removed (maximal byte ranges), kept (the remaining bytes), n_bytes for every row."""
    spans = repeated_spans(documents, length)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            ids, removed, kept, sizes = batch.column("doc_id"), [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = text.encode()
                cuts = merged([(s["start"], s["end"]) for s in spans or ()])
                at, pieces = 0, []
                for a, b in cuts:
                    pieces.append(data[at:a])
                    at = b
                removed.append([{"start": a, "end": b} for a, b in cuts])
                kept.append(b"".join([*pieces, data[at:]]))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64())],
                names=["doc_id", "removed", "kept", "n_bytes"],
            )

    return (
        _texts(documents)
        .join(spans, "tid", "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(run, f"doc_id {kind}, removed array<struct<start:int,end:int>>, kept binary, n_bytes long")
    )


def op6_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
