"""Exact top-k by inner product: a Voronoi kNN join whose bounds come from summaries of the groups.

1. Components x become floor(scale * x).  Rows with one vector are one entry that keeps the ``k + 1`` least
   ids: ties go to smaller ids, so no other of them can be among anyone's best k, whatever the copies.
2. Pivots are ``PIVOTS`` entries drawn by hash.  Every entry goes to the cell of its nearest pivot.  A
   cell's summary has its size, radius, largest norm and the k + 1 entries nearest to its pivot.
3. The distinct query vectors are grouped by the same pivots.  Exact scores against the summaries' entries
   give each query a k-th best score that the answer reaches; in a cell with pivot p and radius r no score
   passes q.p + |q| r, nor |q| times the largest norm.  A query is replicated only to cells whose bound
   reaches its k-th best so far.
4. Cells are cut into tiles of about ``TILE`` entries, and a cell that more than ``VISITS`` queries visit
   gets its tiles in several copies that share the visits.  In each, entries are sorted before queries: the
   entries are one matrix, and queries stream past it in batches.  The best of all tiles are merged.

Scores are exact: products are summed in doubles where the norms prove that every partial sum is below
2**53, else in whole numbers of any length; a score beyond 64 bits is set to the nearest that fits.  A
shorter vector counts as padded with zeros.

Defined cases: vectors null, or with a null or non-finite component, take no part, nor do rows without an
id; an exact repeat of a row counts once; rows with one id and different vectors are rows of their own, and
only the query's own row is left out; fewer than k candidates give as many rows; an empty table gives none;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripline.llm.common import stored, table

PIVOTS = 64
#: Entries of a tile, about: the matrix that a task holds.
TILE = 16_384
#: Queries that one copy of a cell's tiles serves, about.
VISITS = 1 << 17
#: Queries of one matrix product.
BATCH = 256
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, vec): whole-number components of the rows that take part."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    whole = F.transform(x, lambda v: _floor(v * float(scale)))
    return vectors.where(F.col("vec_id").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec"))


def _floor(x: Column) -> Column:
    """floor as a double; beyond 2**52 a double has no fraction."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double") + 0.0).otherwise(x)


def scores(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact."""
    most = np.abs(queries).max(initial=0) * np.abs(entries).max(initial=0) * max(queries.shape[1], 1)
    if most < 1 << 53:
        return (queries @ entries.T).astype(np.int64)
    a = np.array([[int(x) for x in r] for r in queries], object)
    b = np.array([[int(x) for x in r] for r in entries], object)
    return np.clip(a @ b.T, _LEAST, _MOST).astype(np.int64)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    at = np.arange(width) < sizes[:, None]
    out[at] = flat
    return out


def entries_of(rows: DataFrame, k: int) -> DataFrame:
    """(key, key2, vec, ids): each distinct vector with its k + 1 least ids."""
    keyed = rows.select(F.xxhash64("vec").alias("key"), F.xxhash64(F.lit(1), "vec").alias("key2"), "vec", "vec_id").distinct()
    least = F.row_number().over(Window.partitionBy("key", "key2").orderBy("vec_id"))
    held = keyed.withColumn("at", least).where(F.col("at") <= k + 1)
    return held.groupBy("key", "key2").agg(F.first("vec").alias("vec"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


class Summaries:
    """What all tasks know of the cells: at most PIVOTS x (k + 2) vectors."""

    def __init__(self, pivots: np.ndarray, cells: dict[int, tuple], entries: np.ndarray, ids: list[list[int]]):
        n = len(pivots)
        self.pivots, self.entries = pivots, entries
        self.size, self.radius, self.norm = (np.array([float(cells.get(c, (0, 0, 0))[i]) for c in range(n)]) for i in range(3))
        self.weight = np.array([len(i) for i in ids], np.int64)

    def reached(self, queries: np.ndarray, k: int) -> np.ndarray:
        """A score that k candidates besides the query's own row reach, for each query; the least of all where there are not as many."""
        out = np.full(len(queries), _LEAST, np.int64)
        if self.weight.sum() > k:
            found = scores(queries, self.entries)
            order = np.argsort(-found, 1, kind="stable")
            # one more than k, since one may be the query's own
            at = (np.cumsum(self.weight[order], 1) > k).argmax(1)
            out = np.take_along_axis(found, np.take_along_axis(order, at[:, None], 1), 1)[:, 0]
        return out

    def needed(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Which cells may hold one of each query's best."""
        norms = np.linalg.norm(queries, axis=1)
        bound = np.minimum(queries @ self.pivots.T + norms[:, None] * self.radius, norms[:, None] * self.norm)
        # doubles may err by so much
        slack = 1 + 1e-9 * norms[:, None] * (self.norm + np.linalg.norm(self.pivots, axis=1))
        return (self.size > 0) & (bound + slack >= self.reached(queries, k)[:, None].astype(float) * (1 - 1e-12) - 1)


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and distance of each vector, a little rounded up."""
    gaps = (vectors**2).sum(1)[:, None] - 2 * vectors @ pivots.T + (pivots**2).sum(1)
    cell = gaps.argmin(1)
    return cell, np.linalg.norm(vectors - pivots[cell], axis=1) * (1 + 1e-9) + 1e-6


def _celled(entries: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            v = matrix(batch.column("vec"), pivots.shape[1])
            cell, far = nearest(v, pivots)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(np.linalg.norm(v, axis=1) * (1 + 1e-9) + 1e-6)],
                names=[*batch.schema.names, "cell", "far", "norm"],
            )

    return entries.mapInArrow(run, "key long, key2 long, vec array<double>, ids array<long>, cell int, far double, norm double")


def summarise(entries: DataFrame, pivots: np.ndarray, k: int) -> Summaries:
    """Summaries of entries that have a cell."""
    cells = entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).collect()  # one row a pivot
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("far", "key", "key2"))
    near = entries.select("cell", "far", "key", "key2", "vec", "ids").withColumn("at", rank).where(F.col("at") <= k + 1)
    near = near.select("vec", "ids").collect()  # at most k + 1 rows a pivot
    held = np.zeros((len(near), pivots.shape[1]))
    for i, r in enumerate(near):
        held[i, : len(r.vec)] = r.vec
    return Summaries(pivots, {r.cell: (r.n, r.far, r.norm) for r in cells}, held, [r.ids for r in near])


_SIDES = "cell int, tile int, copy int, side int, key long, key2 long, vec array<double>, ids array<long>"
_FOUND = "key long, key2 long, own boolean, vec_id long, score long"


def _visits(queries: DataFrame, known: Summaries, k: int) -> DataFrame:
    """(cell, key, key2, vec) for every cell that a query needs."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                row, cell = np.nonzero(known.needed(matrix(part.column("vec"), known.pivots.shape[1]), k))
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), *(taken.column(c) for c in ("key", "key2", "vec"))], names=["cell", "key", "key2", "vec"]
                )

    return queries.select("key", "key2", "vec").mapInArrow(run, "cell int, key long, key2 long, vec array<double>")


def best_of(found: np.ndarray, ids: list[np.ndarray], k: int) -> Iterator[tuple[int, int, int]]:
    """(entry, id, score) of the k + 1 best for one query: by score, then by id."""
    at = np.argpartition(-found, k)[: k + 1] if len(found) > k + 1 else np.arange(len(found))
    at = np.flatnonzero(found >= found[at].min()) if len(at) else at
    rows = sorted((-int(found[e]), int(i), int(e)) for e in at for i in ids[e])
    return ((e, i, -s) for s, i, e in rows[: k + 1])


def _solve(width: int, k: int):
    """Streams tiles: their entries, then the queries that visit them."""

    def run(batches):
        place, held, keys, ids, entries = None, [], [], [], None
        for batch in batches:
            column = {c: batch.column(c) for c in batch.schema.names}
            where = np.stack([column[c].to_numpy() for c in ("cell", "tile", "copy", "side")], 1)
            edges = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
            for a, b in zip([0, *edges], [*edges, len(where)]):
                part = batch.slice(a, b - a)
                vectors = matrix(part.column("vec"), width)
                names = list(zip(part.column("key").to_pylist(), part.column("key2").to_pylist()))
                if tuple(where[a, :3]) != place:
                    place, held, keys, ids, entries = tuple(where[a, :3]), [], [], [], None
                if where[a, 3] == 0:
                    held.append(vectors)
                    keys += names
                    ids += part.column("ids").to_pylist()
                elif held:
                    entries = np.concatenate(held) if entries is None else entries
                    for at in range(0, len(vectors), BATCH):
                        out = []
                        for name, row in zip(names[at : at + BATCH], scores(vectors[at : at + BATCH], entries)):
                            out += [(*name, keys[e] == name, i, s) for e, i, s in best_of(row, ids, k)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names_out)

    names_out = [x.split()[0] for x in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    return run


def top_k(vectors: DataFrame, wanted: Column, k: int = 10, column: str = "embedding", scale: int = 1024, pivots: int = PIVOTS, tile: int = TILE, visits: int = VISITS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row that ``wanted`` (a condition on vec_id) picks."""
    spark = vectors.sparkSession
    rows = quantised(vectors, column, scale)
    entries = stored(entries_of(rows, k), "topk-entries")
    drawn = entries.orderBy(F.xxhash64("key"), "key", "key2").limit(pivots).collect()
    width = entries.agg(F.max(F.size("vec")).alias("n")).first().n or 0
    if not drawn:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    points = np.zeros((len(drawn), width))
    for i, r in enumerate(drawn):
        points[i, : len(r.vec)] = r.vec
    celled = stored(_celled(entries, points), "topk-cells")
    known = summarise(celled, points, k)

    asked = rows.where(wanted).select(F.xxhash64("vec").alias("key"), F.xxhash64(F.lit(1), "vec").alias("key2"), "vec", "vec_id").distinct()
    queries = asked.groupBy("key", "key2").agg(F.first("vec").alias("vec"))
    sent = stored(_visits(queries, known, k), "topk-visits")
    # two numbers for each cell
    tiles = [max(1, -(-int(n) // tile)) for n in known.size]
    asks = {r.cell: r.n for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    copies = [-(-asks.get(c, 0) // visits) for c in range(len(tiles))]

    def of(numbers: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, numbers)), F.col("cell") + 1)

    def each(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    spread = F.xxhash64("key2", "key")
    tiled = celled.where(of(copies) > 0).withColumn("tile", F.pmod(spread, of(tiles)).cast("int")).withColumn("copy", each(of(copies)))
    tiled = tiled.select("cell", "tile", "copy", F.lit(0).alias("side"), "key", "key2", "vec", "ids")
    asking = sent.withColumn("copy", F.pmod(spread, of(copies)).cast("int")).withColumn("tile", each(of(tiles)))
    asking = asking.select("cell", "tile", "copy", F.lit(1).alias("side"), "key", "key2", "vec", F.lit(None).cast("array<bigint>").alias("ids"))
    place = ["cell", "tile", "copy"]
    sides = tiled.unionByName(asking).repartition(*place).sortWithinPartitions(*place, "side")
    found = sides.mapInArrow(_solve(width, k), _FOUND)

    best = [F.col("score").desc(), F.col("vec_id"), F.col("own")]
    merged = found.withColumn("at", F.row_number().over(Window.partitionBy("key", "key2").orderBy(*best))).where(F.col("at") <= k + 1)
    joined = asked.select("key", "key2", F.col("vec_id").alias("query_id")).join(merged, ["key", "key2"])
    others = joined.where(~(F.col("own") & (F.col("vec_id") == F.col("query_id"))))
    # rows of one id and different vectors are queries of their own
    rank = F.row_number().over(Window.partitionBy("query_id", "key", "key2").orderBy(*best))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::bigint as score
  from rows q join rows c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, rank::integer as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 10
"""
