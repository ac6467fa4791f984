"""Similarity self-join of documents on distinct word shingles, by a token-group matrix.

Documents link when the Jaccard similarity of their shingle sets is ``num/den`` or more; the result is the
connected components of all links, exactly.

1. Documents with one shingle set are one class member, known by the set's digest.
2. Shingles have one global order: common ones last (those that many documents of a partition share,
   summed over all partitions; at most ``MOST_COMMON``, by raising the count that makes a shingle
   common), then by hash.  The prefix of a set is its first ``n - ceil(t n) + 1`` shingles; two sets that
   link share a shingle of their prefixes.
3. Similar sets are put into one group: that of the first common shingle in the prefix (near copies of a
   text that many documents hold share it, their own edits do not count), else of the first shingle.
4. The matrix has a row for each (token, group): the union of the members' prefixes, with the members'
   sizes.  A query meets a group's column in some of its prefix tokens; that count plus the rest of the
   query bounds the overlap with every member.  Groups whose bound is too low stay closed.
5. Open groups: each query is compared with the group's leader first, and the links are joined to
   components; some turns follow with other leaders from the group's largest component, for queries
   outside it.  Then blocks of queries meet blocks of members, in each open group that still holds
   more than one component, less the blocks that are of one component or whose bound is too low.  A
   large group of near copies costs a few comparisons for each member, no pairs are listed, and no link
   that could join two components is left out.  Comparisons are exact, on the whole sets.

Defined cases: null and empty texts have no shingles, link with nothing and are their own component; a
text of fewer words than a shingle is one shingle; repeated rows link with each other; a null doc_id
takes part and is never a component's id (unless all are null); an empty table gives no rows; columns
but doc_id and text are not read for classes, so their names may be those of results.  Shingles are
compared by 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripline.llm.common import components, mix, segment_sums, shingle_sets, stored, table, text_batches, text_slices

SHINGLE = 5
NUM, DEN = 75, 100
#: Common shingles are sent to every task: so many 64-bit numbers at most.
MOST_COMMON = 1 << 20
#: A shingle is common when more documents than this have it.
COMMON = 64
#: Turns of comparisons with another leader of a group's largest component, as long as a tenth of them link.
TURNS = 8
#: Sets that a task compares with as many others at once.
BLOCK = 128
#: Tokens that a task holds while it counts.
HELD = 1 << 21


def _ceil_share(n, num: int, den: int):
    return -(-n * num // den)


def _digests(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.bincount(rows, minlength=n_rows)
    return mix(segment_sums(mix(hashes), rows, n_rows) + sizes.astype(np.uint64)), sizes


def _prefixes(rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, common: np.ndarray, num: int, den: int):
    """(row, token, common) of the prefixes, in the global order; input is sorted by row and hash."""
    is_common = np.zeros(len(hashes), bool)
    if len(common):
        at = np.searchsorted(common, hashes)
        at[at == len(common)] = 0
        is_common = common[at] == hashes
        order = np.lexsort((is_common, rows))  # stable: hash order is kept within
        rows, hashes, is_common = rows[order], hashes[order], is_common[order]
    firsts = np.cumsum(sizes) - sizes
    keep = np.arange(len(rows)) - firsts[rows] <= (sizes - _ceil_share(sizes, num, den))[rows]
    return rows[keep], hashes[keep], is_common[keep]


def _common_shingles(documents: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of the common shingles, MOST_COMMON at most."""

    def flush(tokens: list, owners: list):
        t, d = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((d, t))
        t, d = t[order], d[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
        t = t[new]
        first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.zeros(0, int)
        count = np.diff(np.append(first, len(t)))
        many = count > 1
        return pa.RecordBatch.from_arrays([pa.array(t[first][many].view(np.int64)), pa.array(count[many])], names=["token", "n"])

    def count(batches):
        tokens, owners, held = [], [], 0
        for batch in batches:
            for _, end, data, offsets in text_slices(batch.column("text")):
                rows, hashes, _ = shingle_sets(data, offsets, k)
                digests, _ = _digests(rows, hashes, len(offsets) - 1)
                tokens.append(hashes)
                owners.append(digests[rows])
                held += len(hashes)
                if held >= HELD:
                    yield flush(tokens, owners)
                    tokens, owners, held = [], [], 0
        if tokens:
            yield flush(tokens, owners)

    counts = stored(
        documents.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > COMMON),
        "ngram-common",
    )
    least = COMMON
    while counts.where(F.col("n") > least).count() > MOST_COMMON:
        least *= 2
    # at most MOST_COMMON numbers
    return np.sort(counts.where(F.col("n") > least).select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


_SETS = "doc_id {kind}, thash long, n int, digest long, grp long, tail long, rare array<long>, common array<long>"


def _sets(documents: DataFrame, common: np.ndarray, k: int, num: int, den: int) -> DataFrame:
    """One row for each document: set size, digest, group and prefix."""
    kind = dict(documents.dtypes)["doc_id"]
    held = documents.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                count = end - first
                rows, hashes, _ = shingle_sets(data, offsets, k)
                digests, sizes = _digests(rows, hashes, count)
                rows, hashes, is_common = _prefixes(rows, hashes, sizes, held.value, num, den)
                some = sizes > 0
                grp = np.zeros(count, np.int64)
                # the first common shingle of the prefix, else the first one
                for mine in (np.arange(len(rows)), np.flatnonzero(is_common)):
                    owner, first_at = np.unique(rows[mine], return_index=True)
                    grp[owner] = hashes[mine[first_at]].view(np.int64)
                # where the prefix ends in the global order
                tail = np.zeros(count, np.int64)
                ends = np.searchsorted(rows, np.arange(count), "right") - 1
                tail[some] = ((hashes[ends[some]] >> np.uint64(2)) | (is_common[ends[some]].astype(np.uint64) << np.uint64(62))).astype(np.int64)
                lists = []
                for mine in (~is_common, is_common):
                    ends = np.searchsorted(rows[mine], np.arange(count + 1)).astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[mine].view(np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, count),
                        batch.column("thash").slice(first, count),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(digests.view(np.int64), mask=~some),
                        pa.array(grp, mask=~some),
                        pa.array(tail),
                        *lists,
                    ],
                    names=["doc_id", "thash", "n", "digest", "grp", "tail", "rare", "common"],
                )

    return documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("thash")).mapInArrow(run, _SETS.format(kind=kind))


def _alike(n: Column, m: Column, num: int, den: int) -> Column:
    """Sizes that allow a link."""
    return (F.least(n, m) * den) >= (F.greatest(n, m) * num)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of digests that link."""

    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            # both texts of a pair in turn: rows 2 i and 2 i + 1
            both = [t for ab in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()) for t in ab]
            sizes, shared = np.zeros(len(both), np.int64), np.zeros(len(a), np.int64)
            at = 0
            while at < len(both):
                end, room = at, 1 << 20
                while end < len(both) and (end == at or room > 0):
                    room -= len(both[end]) + len(both[end + 1])
                    end += 2
                for first, last, data, offsets in text_slices(pa.array(both[at:end], pa.large_string()), 1 << 62):
                    rows, hashes, _ = shingle_sets(data, offsets, k)
                    sizes[at:end] = np.bincount(rows, minlength=end - at)
                    pair = rows // 2
                    order = np.lexsort((hashes, pair))
                    p, h = pair[order], hashes[order]
                    same = (p[1:] == p[:-1]) & (h[1:] == h[:-1])
                    shared[at // 2 : end // 2] = np.bincount(p[1:][same], minlength=(end - at) // 2)
                at = end
            link = den * shared >= num * (sizes[::2] + sizes[1::2] - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[link]), pa.array(b[link])], names=["a", "b"])

    ta, tb = texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _block_links(rows: pd.DataFrame, k: int, num: int, den: int) -> pd.DataFrame:
    """Links between two blocks of at most BLOCK sets, one for each pair of components that they join."""
    hashes_of, owners = [], []
    for first, _, data, offsets in text_slices(pa.array(rows["text"], pa.large_string())):
        owner, hashes, _ = shingle_sets(data, offsets, k)
        hashes_of.append(hashes)
        owners.append(owner + first)
    tokens, token = np.unique(np.concatenate(hashes_of), return_inverse=True)
    owner, side = np.concatenate(owners), rows["side"].to_numpy()
    place = np.where(side == 0, np.cumsum(side == 0), np.cumsum(side == 1)) - 1
    both = np.bincount(token[side[owner] == 0], minlength=len(tokens)).astype(bool) & np.bincount(token[side[owner] == 1], minlength=len(tokens)).astype(bool)
    column = np.cumsum(both) - 1
    keep = both[token]
    token, owner = column[token[keep]], owner[keep]
    q, t = rows[side == 0], rows[side == 1]
    shared = np.zeros((len(q), len(t)), np.float32)
    for start in range(0, int(both.sum()), 1 << 15):
        here = (token >= start) & (token < start + (1 << 15))
        held = [np.zeros((len(x), 1 << 15), np.float32) for x in (q, t)]
        for number in (0, 1):
            mine = here & (side[owner] == number)
            held[number][place[owner[mine]], token[mine] - start] = 1
        shared += held[0] @ held[1].T
    total = q["n"].to_numpy()[:, None] + t["n"].to_numpy()[None, :]
    # the bound of a query holds for members whose prefix ends no sooner; such a pair meets in one of the two groups at least
    link = (den * shared >= num * (total - shared)) & (q["root"].to_numpy()[:, None] != t["root"].to_numpy()[None, :])
    i, j = np.nonzero(link)
    found = pd.DataFrame({"a": q["root"].to_numpy()[i], "b": t["root"].to_numpy()[j]})
    return found.drop_duplicates()


def similarity_classes(documents: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, thash (xxhash64 of the text), n_shingles, class_id (digest of a member; null: no shingles), component_id."""
    documents = text_batches(documents)
    sets = stored(_sets(documents, _common_shingles(documents, k), k, num, den), "ngram-sets")
    members = sets.where("n > 0").groupBy("digest").agg(F.first("n").alias("n"), F.first("grp").alias("grp"), F.first("tail").alias("tail"), F.min("thash").alias("thash"))
    members = stored(members, "ngram-members")

    by_token = Window.partitionBy("token").orderBy("digest")
    rare = sets.select(F.explode("rare").alias("token"), "digest")
    rare = (
        rare.withColumn("before", F.lag("digest").over(by_token))
        .withColumn("after", F.lead("digest").over(by_token))
        .where("before <> digest or after <> digest")
        .select("token", "digest")
    )
    common = sets.select(F.explode("common").alias("token"), "digest")
    shared = stored(rare.unionByName(common).distinct().join(members.select("digest", "n", "grp", "tail"), "digest"), "ngram-shared")
    matrix = shared.groupBy("token", F.col("grp").alias("g")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("m"))
    n, lo, hi = F.col("n"), F.col("lo"), F.col("hi")
    met = (
        shared.join(matrix, "token")
        .where((F.col("g") != F.col("grp")) | (F.col("m") > 1))
        .where((hi * den >= n * num) & (n * den >= lo * num))
        .groupBy("digest", "n", "tail", "grp", "g")
        .agg(F.count("*").alias("tokens"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    least_n = F.ceil(n * num / den)
    # the tokens met, and all that lies behind the prefix, bound the overlap
    met = met.withColumn("bound", F.col("tokens") + least_n - 1)
    opened = stored(met.where(F.col("bound") * (num + den) >= (n + F.greatest(lo, least_n)) * num).select("digest", "n", "tail", "bound", "grp", "g"), "ngram-open")

    def pairs_of(df: DataFrame) -> DataFrame:
        """Distinct unordered pairs of (digest, n, s, m) rows whose sizes allow a link."""
        df = df.where("digest <> s").where(_alike(F.col("n"), F.col("m"), num, den))
        return df.select(F.least("digest", "s").alias("a"), F.greatest("digest", "s").alias("b")).distinct()

    in_group = members.select(F.col("digest").alias("s"), F.col("n").alias("m"), F.col("tail").alias("s_tail"), F.col("grp").alias("g"))
    # the member that has most of its shingles in common with its group makes the best leader
    central = opened.where("g = grp").select(F.col("digest").alias("s"), (F.col("bound") / n).alias("central"))
    in_group = in_group.join(central, "s", "left").withColumn("central", F.coalesce("central", F.lit(0.0)))
    leaders = in_group.groupBy("g").agg(F.max(F.struct("central", "s", "m")).alias("l")).select("g", "l.s", "l.m")
    first_pairs = stored(pairs_of(opened.join(leaders, "g")), "ngram-first")
    compared = opened.select("digest").unionByName(in_group.join(opened.select("g").distinct(), "g").select(F.col("s").alias("digest"))).distinct()
    wanted = members.join(compared, "digest").select("digest", "thash")
    texts = documents.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("thash", F.xxhash64("text"))
    texts = stored(texts.join(wanted, "thash").dropDuplicates(["digest"]).select("digest", "text"), "ngram-texts")
    opened_members = stored(in_group.join(opened.select("g").distinct(), "g"), "ngram-opened")
    tested = first_pairs
    links = stored(_verified(first_pairs, texts, k, num, den), "ngram-links")
    roots = components(links)

    def rooted(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.join(roots.select(F.col("node").alias(key), F.col("root").alias(name)), key, "left").withColumn(name, F.coalesce(name, key))

    for turn in range(TURNS):
        parts = rooted(opened_members, "s", "other").groupBy("g", "other")
        leader = F.max(F.struct(F.round("central", 1).alias("c"), F.xxhash64("s", F.lit(turn)).alias("h"), "s", "m"))
        largest = parts.agg(F.count("*").alias("size"), leader.alias("l")).groupBy("g").agg(F.max(F.struct("size", "other", "l")).alias("p"))
        largest = largest.where("p.size > 1").select("g", "p.other", "p.l.s", "p.l.m")
        next_pairs = pairs_of(rooted(opened, "digest", "own").join(largest, "g").where("own <> other"))
        next_pairs = stored(next_pairs.join(tested, ["a", "b"], "left_anti"), "ngram-next")
        found = stored(_verified(next_pairs, texts, k, num, den), "ngram-links")
        n_found, n_next = found.count(), next_pairs.count()
        tested = tested.unionByName(next_pairs)
        if n_found:
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
        if n_found * 10 <= n_next:
            break

    # what is left: blocks of a group's queries against blocks of its members, unless all are in one component
    def blocks(df: DataFrame, name: str) -> DataFrame:
        at = Window.partitionBy("g").orderBy("root", "digest")
        return stored(df.withColumn("block", F.floor((F.row_number().over(at) - 1) / BLOCK)), name)

    def ranges(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy("g", F.col("block").alias(p)).agg(
            F.min("root").alias(p + "_least"), F.max("root").alias(p + "_most"), F.min("n").alias(p + "_lo"), F.max("n").alias(p + "_hi"), F.max("bound").alias(p + "_bound")
        )

    queries = blocks(rooted(opened.select("digest", "n", "tail", "bound", "g"), "digest", "root"), "ngram-queries")
    targets = opened_members.select(F.col("s").alias("digest"), F.col("m").alias("n"), F.col("s_tail").alias("tail"), F.lit(0).cast("long").alias("bound"), "g")
    targets = blocks(rooted(targets, "digest", "root"), "ngram-targets")
    meeting = stored(
        ranges(queries, "q")
        .join(ranges(targets, "t"), "g")
        .where("q_least <> q_most or t_least <> t_most or q_least <> t_least")
        .where((F.col("q_hi") * den >= F.col("t_lo") * num) & (F.col("t_hi") * den >= F.col("q_lo") * num))
        .where(F.col("q_bound") * (num + den) >= (F.col("q_lo") + F.col("t_lo")) * num)
        .select("g", "q", "t"),
        "ngram-meeting",
    )

    def side(df: DataFrame, p: str, number: int) -> DataFrame:
        rows = meeting.join(df.withColumnRenamed("block", p), ["g", p]).join(texts, "digest")
        return rows.select("g", "q", "t", F.lit(number).alias("side"), "digest", "n", "tail", "bound", "root", "text")

    found = (
        side(queries, "q", 0)
        .unionByName(side(targets, "t", 1))
        .groupBy("g", "q", "t")
        .applyInPandas(lambda rows: _block_links(rows, k, num, den), "a long, b long")
    )
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
    classes = members.select("digest").join(roots, F.col("digest") == F.col("node"), "left").select("digest", F.coalesce("root", "digest").alias("class_id"))
    placed = sets.select("doc_id", "thash", "n", "digest").join(classes, "digest", "left")
    least = placed.where("class_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "class_id", "left").select(
        "doc_id",
        "thash",
        F.col("n").cast("long").alias("n_shingles"),
        "class_id",
        F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The rows of documents, all columns, less all but one of each class: the one with the least doc_id, then text hash.

    Of rows equal in both, the one least in the other columns, in their order, stays (columns of map type
    cannot be ordered and are passed over).  Rows without shingles are all kept.
    """
    classes = similarity_classes(documents)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "thash")
    kept = classes.where("class_id is not null").groupBy("class_id").agg(F.min(order).alias("k")).select(
        F.col("k.doc_id").alias("__id"), F.col("k.thash").alias("__hash"), F.lit(True).alias("__kept")
    )
    hashed = documents.withColumn("__text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = hashed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash")), "left")
    rest = [F.col(f"`{f.name}`") for f in documents.schema if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    one = Window.partitionBy("doc_id", "__text_hash").orderBy(*(rest or [F.lit(1)]))
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return (
        joined.where(F.col("__kept").isNotNull() | ~worded)
        .withColumn("__copy", F.row_number().over(one))
        .where((F.col("__copy") == 1) | ~worded)
        .select(*documents.columns)
    )


def op3_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents")).drop("thash")
