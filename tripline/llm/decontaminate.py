"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact weighted-shingle check.

1. Words are runs of letters and digits, lower-cased.  A window as long as an item (shorter where the
   document ends) lies in a document wherever it would line up with the item at a shared word shingle, and
   wherever a run of shingles shared with the item begins.
2. Each distinct window and each item gets a 64-bit SimHash of its shingles, weighted by their counts.
   Fingerprints are cut into ``RADIUS + 1`` blocks; two within the radius agree in one block at least, so a
   join on (item, block, value) finds every window within the radius of the item that it was placed for.
   Blocks of so few bits alone would pair most windows with most items; the item in the key prevents that.
3. Pairs within the radius pass when the weighted Jaccard similarity of their shingles (sum of the lesser
   counts over the sum of the greater), computed exactly, is ``SIMILAR`` or more.

At a similarity of 0.75 two fingerprints are about 11 bits apart, with a deviation of 3: ``RADIUS`` lies
above that by more than two deviations, and the README has the recall measured against brute force.

Only DataFrame functions run.  Defined cases: null and empty texts, and items without a word, match
nothing; an item of fewer words than a shingle is one shingle, and documents are searched for that
sequence; repeated rows give one row; equal items are reported each; empty tables give no rows;
columns but doc_id, text and item_id are not read, so their names may be those of results, and
``drop_leaks`` keeps them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import stored, table

SHINGLE = 5
SIMILAR = 0.75
RADIUS = 18
#: Shingles of all items up to which the items' tables are broadcast.
SMALL = 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, k: int = SHINGLE) -> Column:
    """Hashes of the k-word shingles in turn; of the whole sequence when it is shorter; none without words."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1)))
    return F.when(n > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, k)))).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Bit b is set when more than half of the hashes have it."""
    half = F.size(hashes)

    def bit(held: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
        return held.bitwiseOR(F.when(ones * 2 > half, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), bit)


def hamming_blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """The values of radius + 1 blocks that make up the 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    pieces = [F.call_function("shiftrightunsigned", fingerprint, F.lit(a)).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    return F.array(*pieces)


def _seeds(items: DataFrame) -> DataFrame:
    """(item, length, m, hash, offset, before) of each distinct shingle of an item: where it comes first, and the shingle before it."""
    places = F.transform("hashes", lambda h, i: F.struct(h.alias("hash"), i.alias("offset"), F.get("hashes", i - 1).alias("before")))
    each = items.select("item", "length", F.size("hashes").alias("m"), F.explode(places).alias("p"))
    first = F.min(F.struct("p.offset", "p.before")).alias("first")
    return each.groupBy("item", "length", "m", "p.hash").agg(first).select("item", "length", "m", "hash", F.col("first.offset").alias("offset"), F.col("first.before").alias("expected"))


def _windows_at(docs: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """(doc_id, thash, item, start, window): the shingles of each window that a shared k-word shingle places."""
    found = docs.where(F.size("words") >= k).select("doc_id", "thash", shingles(F.col("words"), k).alias("hashes"))
    # the outer form: from the inner one Spark infers a filter that splits the text again for every shingle
    found = found.select("doc_id", "thash", "hashes", F.posexplode_outer("hashes").alias("at", "hash")).join(seeds, "hash")
    lined_up = F.greatest(F.col("at") - F.col("offset"), F.lit(0))
    run_begins = ~F.get("hashes", F.col("at") - 1).eqNullSafe(F.col("expected"))
    starts = F.when(run_begins, F.array_distinct(F.array(lined_up, F.col("at")))).otherwise(F.array(lined_up))
    found = found.select("doc_id", "thash", "item", "m", "hashes", F.explode(starts).alias("start"))
    return found.select("doc_id", "thash", "item", "start", F.slice("hashes", F.col("start") + 1, F.col("m")).alias("window"))


def find_leaks(documents: DataFrame, benchmark: DataFrame, similar: float = SIMILAR, radius: int = RADIUS) -> DataFrame:
    """(doc_id, thash, item_id, start_word, similarity): each item that a document holds, at its best placement."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.select("item_id", F.size("words").alias("length"), shingles(F.col("words")).alias("hashes")).distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "length", "hashes")).withColumn("print", simhash(F.col("hashes")))
    items = stored(items, "leak-items")
    small = (items.agg(F.sum(F.size("hashes")).alias("n")).first().n or 0) <= SMALL

    def bounded(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    seeds = _seeds(items)
    docs = documents.select("doc_id", F.xxhash64("text").alias("thash"), words(F.col("text")).alias("words"))
    # sequences shorter than a shingle are looked up by their own length
    lengths = sorted(r.length for r in items.where(F.col("length") < SHINGLE).select("length").distinct().collect())
    placed = _windows_at(docs, bounded(seeds.where(F.col("length") >= SHINGLE)), SHINGLE)
    for k in lengths:
        placed = placed.unionByName(_windows_at(docs, bounded(seeds.where(F.col("length") == k)), k))
    placed = placed.withColumn("wid", F.xxhash64("window")).groupBy("doc_id", "thash", "item", "start", "wid").agg(F.first("window").alias("window"))
    placed = stored(placed, "leak-placed")

    windows = placed.groupBy("wid").agg(F.first("window").alias("hashes"), F.collect_set("item").alias("items"))
    windows = stored(windows.withColumn("print", simhash(F.col("hashes"))), "leak-windows")
    blocks = F.posexplode(hamming_blocks(F.col("print"), radius)).alias("block", "value")
    near = (
        windows.select("wid", "print", F.size("hashes").alias("n"), F.explode("items").alias("item"))
        .select("wid", "print", "n", "item", blocks)
        .join(bounded(items.select("item", F.col("print").alias("item_print"), F.size("hashes").alias("m"), blocks)), ["item", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        .where(F.least("n", "m") >= F.greatest("n", "m") * similar)
        .select("wid", "item", "n", "m")
        .distinct()
    )
    window_counts = windows.select("wid", F.explode("hashes").alias("hash")).groupBy("wid", "hash").agg(F.count("*").alias("c"))
    item_counts = items.select("item", F.explode("hashes").alias("hash")).groupBy("item", "hash").agg(F.count("*").alias("d"))
    common = F.sum(F.least("c", "d"))
    passed = (
        near.join(window_counts, "wid")
        .join(bounded(item_counts), ["item", "hash"])
        .groupBy("wid", "item", "n", "m")
        .agg((common / (F.col("n") + F.col("m") - common)).alias("similarity"))
        .where(F.col("similarity") >= similar)
        .select("wid", "item", "similarity")
    )
    best = F.max_by(F.struct("start", "similarity"), F.struct("similarity", -F.col("start")))
    return (
        placed.drop("window")
        .join(passed, ["wid", "item"])
        .join(bounded(items.select("item", "item_id")), "item")
        .groupBy("doc_id", "thash", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "thash", "item_id", F.col("b.start").alias("start_word"), "b.similarity")
    )


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents, all columns, that hold no benchmark item."""
    leaks = find_leaks(documents, benchmark).select(F.col("doc_id").alias("__id"), F.col("thash").alias("__hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__hash"))
    return documents.join(leaks, same, "left_anti")


def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("thash")
