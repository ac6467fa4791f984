"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Each source's words are cut into at most ``BLOCKS`` blocks by a hash of the row.  A source's target is
   its weight's share of all words, at most ``MOST`` times its size; what is above goes to the other
   sources by weight until none is above.
2. A source gives ``floor(target / size)`` whole passes over its blocks and one partial pass: its
   permuted blocks, as many as fit; the next blocks, of ``END_ROWS`` rows or one block, give rows in hash
   order up to the target, and one row of them is put in or left out if that comes nearer.  So a row is
   taken floor or ceil of target / size times.
3. The quotas (blocks of each source) are split among the output shards by a binary tree: at each node
   the left half draws its number of blocks from the node's blocks without replacement, so the shards'
   shares of each source are exact draws and add up to the quotas.  A shard takes the next blocks of
   each source's permutation, so shards are disjoint, and shuffles its rows by hash.  The few rows at
   the end of a partial pass go to shards by hash.

Defined cases: null text has size 0; null source is a source of its own, the last; a source without
words has target 0 and gives nothing; equal rows lie in one block and are interchangeable; an empty
table gives no rows.  Everything follows from the rows and the seed, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripline.llm.common import table

BLOCKS = 1024
MOST = 3.0
WEIGHTS = (5, 2, 1)
#: Rows among which the end of a partial pass is chosen, unless one block has more.
END_ROWS = 64
#: Rows of the block table (sources x BLOCKS) up to which it is broadcast.
SMALL = 1 << 17


def words_of(text: Column) -> Column:
    """Number of words: runs of characters other than blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of (source, source_size): one row a source, null last.

    Sources in order of their limit per weight: the limit holds for a source when, with all before it at
    their limits, the rest by weight would still be above its own.  That is so for a prefix of the order.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = sizes.withColumn("w", weight).withColumn("limit", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("all", F.sum("source_size").over(every))
        .withColumn("spent", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("w").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("full", F.col("limit") * F.col("left") <= (F.col("all") - F.col("spent")) * F.col("w"))
    )
    full = F.col("full")
    rows = rows.withColumn("level", (F.col("all") - F.sum(F.when(full, F.col("limit")).otherwise(0.0)).over(every)) / F.sum(F.when(full, 0.0).otherwise(F.col("w"))).over(every))
    return rows.select("source", "source_size", F.when(full, F.col("limit")).otherwise(F.least("limit", F.col("level") * F.col("w"))).alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """shards x sources: the tree's draws; columns add up to the quotas, and row sums differ by one at most."""
    quotas = np.asarray(quotas, np.int64)
    out = np.zeros((shards, len(quotas)), np.int64)
    total = int(quotas.sum())
    sizes = np.array([total // shards + (i < total % shards) for i in range(shards)])
    todo = [(0, shards, quotas)]
    while todo:
        low, high, held = todo.pop()
        if high - low == 1:
            out[low] = held
            continue
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(held, int(sizes[low:middle].sum()), method="marginals")
        todo += [(low, middle, draw), (middle, high, held - draw)]
    return out


def mix_plan(documents: DataFrame, shards: int = 8, seed: int = 1, weights=WEIGHTS) -> DataFrame:
    """The documents with size, source_size, target and ``places``: the output shard of each copy taken.

    All columns of documents stay; added ones replace those of the same name.
    """
    added = ("size", "source_size", "target", "places")
    docs = documents.drop(*added)
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    docs = docs.withColumns({"size": words_of(F.col("text")), "__block": F.pmod(key, F.lit(BLOCKS)), "__order": F.xxhash64(key, F.lit(7))})

    blocks = docs.groupBy("source", "__block").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    targets = source_targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size")), weights)
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "__block", F.lit(11)), "__block")
    ahead = permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (
        blocks.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("room", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("rank", F.row_number().over(permuted) - 1)
        .withColumn("n_blocks", F.count("*").over(Window.partitionBy("source")))
        .withColumn("left", F.col("room") - F.sum("words").over(ahead) + F.col("words"))
        .withColumn("whole", F.col("words") <= F.col("left"))
        .withColumn("left", F.max(F.when(~F.col("whole"), F.col("left"))).over(Window.partitionBy("source")))
        .withColumn("nearer", F.sum(F.when(~F.col("whole"), F.col("rows"))).over(ahead) - F.col("rows"))
        .withColumn("partial", F.when(F.col("whole"), "whole").when((F.col("left") > 0) & (F.col("nearer") < END_ROWS), "end").otherwise("none"))
    )
    quotas = blocks.groupBy("source").agg((F.max("passes") * F.max("n_blocks") + F.count_if(F.col("partial") == "whole")).alias("quota"))

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(last=rows["source"].isna()).sort_values(["last", "source"], na_position="last")
        parts = split_quotas(rows["quota"].to_numpy(), shards, seed)
        ends = np.cumsum(parts, axis=0)
        return pd.DataFrame({"source": rows["source"].to_numpy(), "ends": [list(map(int, e)) for e in ends.T]})

    kind = dict(documents.dtypes)["source"]
    # one row for each source
    ends = quotas.groupBy(F.lit(1).alias("one")).applyInPandas(lambda rows: draw(rows), f"source {kind}, ends array<long>")
    blocks = blocks.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    passes = F.col("passes") + (F.col("partial") == "whole").cast("long")
    copies = F.when(passes > 0, F.sequence(F.lit(0).cast("long"), passes - 1))
    shard_of = F.transform(copies, lambda p: F.size(F.filter("ends", lambda e: e <= p * F.col("n_blocks") + F.col("rank"))))
    blocks = blocks.select(
        F.col("source").alias("__s"), F.col("__block").alias("__b"), "source_size", "target", "partial", "left", F.coalesce(shard_of, F.array().cast("array<int>")).alias("all_places")
    )
    if blocks.count() <= SMALL:
        blocks = F.broadcast(blocks)
    joined = docs.join(blocks, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")))
    # rows of the blocks at a target's end, in hash order up to the target; then the one row that comes nearest to the rest
    ending = joined.where("partial = 'end'")
    in_order = Window.partitionBy("source").orderBy("__order", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ending = ending.withColumn("__kept", F.sum("size").over(in_order) - F.col("size") / 2 <= F.col("left"))
    kept = F.col("__kept")
    ending = ending.withColumn("__rest", F.col("left") - F.sum(F.when(kept, F.col("size")).otherwise(0)).over(Window.partitionBy("source")))
    off = F.abs(F.col("__rest") - F.when(kept, -F.col("size")).otherwise(F.col("size")))
    turned = (F.row_number().over(Window.partitionBy("source").orderBy(off, "__order", "doc_id")) == 1) & (off < F.abs("__rest"))
    ending = ending.withColumn("__kept", kept != turned)
    kept = F.col("__kept")
    by_hash = F.array_append("all_places", F.pmod(F.col("__order"), F.lit(shards)).cast("int"))
    ending = ending.withColumn("places", F.when(kept, by_hash).otherwise(F.col("all_places")))
    rest = joined.where("partial <> 'end'").withColumn("places", F.col("all_places"))
    names = [*docs.columns[: len(documents.drop(*added).columns)], *added]
    return rest.select(*names).unionByName(ending.select(*names))


def draw_mix(documents: DataFrame, shards: int = 8, seed: int = 1, weights=WEIGHTS) -> DataFrame:
    """The mix itself: every copy taken as a row with all columns of documents, its ``mix_shard``, and ``mix_order`` to shuffle a shard by."""
    plan = mix_plan(documents, shards, seed, weights)
    copies = plan.select(*documents.columns, F.posexplode("places").alias("__copy", "mix_shard"))
    order = F.xxhash64(F.lit(seed), "doc_id", "text", "__copy", F.lit(13))
    return copies.withColumn("mix_order", order).drop("__copy")


def op7_splitting_tree_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("places")).alias("taken"), "places")
