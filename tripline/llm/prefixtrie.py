"""Conversation prefix trie: shards of balanced parentheses whose shared spines are merged.

1. A turn is a symbol, the 128-bit digest of its role and text, with the code points of its text.  A
   sequence of d turns is known by two 64-bit sums (exclusive or) of hashes of (place, symbol); sums run
   inside blocks of ``BLOCK`` turns, and the blocks' totals are summed apart, so one conversation may be of
   any length.  Equal (depth, sums) are one node; its smallest member names it.
2. Nodes named by one conversation form a chain, and the way from the root to a node is a list of
   (conversation, last depth on its chain).  Sorted by that list, nodes are in preorder: a node, then the
   chains that leave it, then the rest of its own chain.
3. Range partitions of that order, about ``SHARD_NODES`` nodes each, are the shards.  A shard is coded as
   balanced parentheses with the least and greatest excess of blocks and of the blocks' pairs above them;
   ``find_close`` delimits subtrees, counts of ``()`` pairs give leaves, cumulative weights give savings.
4. A node still open at its shard's end lies on the spine that later shards share.  Each shard tells where
   its depth first falls to each lower value, with its counts up to there; one pass over these few rows (at
   most shards x shared depth) closes the spines.  An open node of a single member needs no such pass: what
   follows is the rest of one conversation.

Defined cases: null role or text is empty; rows without conv_id take no part; equal turns of a conversation
(null is first) are ordered by the digest of role and text, and repeated rows are turns of their own;
texts of any length count whole; an empty table gives no rows; other columns, whatever their names, are
not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripline.llm.common import stored, table

#: Turns whose prefix sums one window holds.
BLOCK = 4096
#: Nodes of a shard, about.
SHARD_NODES = 1 << 16
#: Parentheses of a block of the excess index.
PARENS = 64
#: Ids in one piece of a node's list of ends.
ENDS = 4096


class Parentheses:
    """Balanced parentheses of a preorder run of nodes; closes of nodes opened before the run are left out."""

    def __init__(self, depths: np.ndarray):
        n = len(depths)
        floor = np.minimum.accumulate(depths)
        closes = np.maximum(depths[:-1] - np.maximum(depths[1:], floor[:-1]) + 1, 0)
        self.opens = np.arange(n)
        self.opens[1:] += np.cumsum(closes)
        self.bits = np.zeros(int(self.opens[-1]) + 1, bool)
        self.bits[self.opens] = True
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        blocks = 1 << max(0, (-(-len(self.bits) // PARENS) - 1).bit_length())
        low = np.full(blocks * PARENS, np.iinfo(np.int64).max)
        high = np.full(blocks * PARENS, np.iinfo(np.int64).min)
        low[: len(self.excess)] = high[: len(self.excess)] = self.excess
        self.least, self.greatest = [low.reshape(blocks, PARENS).min(1)], [high.reshape(blocks, PARENS).max(1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(1))
            self.greatest.append(self.greatest[-1].reshape(-1, 2).max(1))
        pairs = np.zeros(len(self.bits) + 1, np.int64)
        pairs[1:-1] = np.cumsum(self.bits[:-1] & ~self.bits[1:])
        pairs[-1] = pairs[-2]
        #: Pairs ``()`` that begin before each place.
        self.pairs = pairs

    def _scan(self, start: np.ndarray, want: np.ndarray) -> np.ndarray:
        """First place from ``start`` to its block's end with the excess wanted, or -1."""
        found = np.full(len(start), -1)
        active = np.arange(len(start))
        at = start.copy()
        stop = np.minimum((start // PARENS + 1) * PARENS, len(self.excess))
        while len(active):
            active = active[at[active] < stop[active]]
            hit = self.excess[at[active]] == want[active]
            found[active[hit]] = at[active[hit]]
            active = active[~hit]
            at[active] += 1
        return found

    def _holds(self, level: int, node: np.ndarray, want: np.ndarray) -> np.ndarray:
        """Whether a stretch has the excess; steps are of one, so it does when its range does."""
        return (self.least[level][node] <= want) & (want <= self.greatest[level][node])

    def find_close(self) -> np.ndarray:
        """The closing place of each node, -1 where the run ends first."""
        want = self.excess[self.opens] - 1
        out = np.full(len(want), -1)
        nexts = self.opens + 1
        inside = nexts % PARENS != 0
        out[inside] = self._scan(nexts[inside], want[inside])
        rest = np.flatnonzero(out < 0)
        node = self.opens[rest] // PARENS
        block = np.full(len(rest), -1)
        climbing = np.arange(len(rest))
        for level in range(len(self.least) - 1):
            left = climbing[node[climbing] % 2 == 0]
            right = left[self._holds(level, node[left] + 1, want[rest[left]])]
            down = node[right] + 1
            for below in range(level - 1, -1, -1):
                down *= 2
                down += ~self._holds(below, down, want[rest[right]])
            block[right] = down
            climbing = np.setdiff1d(climbing, right, assume_unique=True)
            node[climbing] //= 2
        met = np.flatnonzero(block >= 0)
        out[rest[met]] = self._scan(block[met] * PARENS, want[rest[met]])
        return out


_DONE, _RECORD, _OPEN, _TOTAL = range(4)
_SHARD = (
    "shard int, kind int, seq long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, parens binary"
)
_NAMES = [x.split()[0] for x in _SHARD.split(", ")]
_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.binary()]


def _out(shard: int, kind: int, seq, conv, depth, parent, members, children, leaves, saved, parens=None) -> pa.RecordBatch:
    n = len(seq)
    columns = [np.full(n, shard), np.full(n, kind), seq, conv, depth, parent, members, children, leaves, saved, parens or [None] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def shard_nodes(shard: int, conv: np.ndarray, depth: np.ndarray, parent: pa.Array, members: np.ndarray, chars: np.ndarray):
    """Batches of a shard's settled nodes, falls of depth, open nodes and totals, in _SHARD's columns."""
    n = len(depth)
    seq = np.arange(n)
    tree = Parentheses(depth)
    close = tree.find_close()
    closed = close >= 0
    ranks = np.cumsum(tree.bits)
    end = np.where(closed, ranks[close], n)
    weights = np.zeros(n + 1, np.int64)
    np.cumsum((members - 1) * chars, out=weights[1:])
    leaves = tree.pairs[np.where(closed, close, len(tree.bits))] - tree.pairs[tree.opens]
    saved = weights[end] - weights[:-1]
    values, rank = np.unique(depth, return_inverse=True)
    places = np.sort(rank * (n + 1) + seq)
    below = np.minimum(rank + 1, len(values) - 1)
    has = values[below] == depth + 1
    children = np.searchsorted(places, below * (n + 1) + end) - np.searchsorted(places, below * (n + 1) + seq + 1)
    children[~has] = 0
    # what follows an open node of one member is the rest of that conversation
    single = ~closed & (members == 1) & (seq < n - 1)
    leaves[single], children[single] = 1, 1
    done, still = np.flatnonzero(closed | single), np.flatnonzero(~closed & ~single)
    pick = lambda at: (seq[at], conv[at], depth[at], parent.take(pa.array(at)), members[at], children[at])
    yield _out(shard, _DONE, *pick(done), leaves[done], saved[done])
    floor = np.minimum.accumulate(depth)
    falls = np.flatnonzero(depth == floor)
    value, first, count = np.unique(-depth[falls], return_index=True, return_counts=True)
    at, none = falls[first], [None] * len(first)
    yield _out(shard, _RECORD, seq[at], none, -value, none, none, count, tree.pairs[tree.opens[at]], weights[at])
    yield _out(shard, _OPEN, *pick(still), tree.pairs[tree.opens[still]], weights[still])
    yield _out(shard, _TOTAL, [n], [None], [depth[-1]], [None], [None], [None], [tree.pairs[-1]], [weights[-1]], [np.packbits(tree.bits).tobytes()])


def _merge_spines(batches):
    """The open nodes of all shards, in order, closed where a later shard's depth falls to theirs."""
    stack: list[list] = []
    settled: list[list] = []
    leaves = saved = 0
    last = None

    def close(depth: int, leaves: int, saved: int) -> None:
        while stack and stack[-1][1] >= depth:
            conv, d, parent, members, children, l0, s0 = stack.pop()
            settled.append([conv, d, parent, members, children, leaves - l0, saved - s0])

    def flush():
        columns = list(zip(*settled))
        settled.clear()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES[3:10])

    for batch in batches:
        for row in batch.to_pylist():
            depth, l, s = row["depth"], row["n_leaves"], row["saved_tokens"]
            if row["kind"] == _RECORD:
                if last is not None and depth <= last:
                    leaves += 1  # the last node of the shard before has no child
                last = None
                close(depth, leaves + l, saved + s)
                if stack and stack[-1][1] == depth - 1:
                    stack[-1][4] += row["n_children"]
            elif row["kind"] == _OPEN:
                stack.append([row["conv_id"], depth, row["parent_conv_id"], row["n_convs"], row["n_children"], leaves + l, saved + s])
            else:
                leaves, saved, last = leaves + l, saved + s, depth
        if settled:
            yield from flush()
    close(-1, leaves + 1, saved)
    if settled:
        yield from flush()


def turn_symbols(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, sym, chars): the turns of each conversation, numbered from 1.

    Rows are numbered inside range partitions; a conversation that spans several gets the counts of those
    before, at most one row for each partition.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("sym"),
        F.char_length(text).cast("long").alias("chars"),
    )
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = F.col("turn").asc_nulls_first()
    dealt = known.repartitionByRange(parts, F.col("conv_id"), turn, F.col("sym")).withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "trie-turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    before = counts.select("conv_id", "part", before.alias("before")).where("before > 0")
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(turn, F.col("sym")))
    numbered = dealt.withColumn("at", inside).join(F.broadcast(before), ["conv_id", "part"], "left")
    return numbered.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "sym", "chars")


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the conversations rebuilt on the first turns of their group's conversation.

    Conversation c begins with the first h turns of c - c % group and goes on with its own after its first
    h, where h is the unsigned crc32 of its decimal id modulo ``most``.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), head.alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = turns.where((F.col("conv_id") % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    lent = heads.join(convs.select("base", "conv_id", "h"), "base").where("pos <= h").select("conv_id", "pos", "sym", "chars")
    own = turns.join(convs.select("conv_id", "h", "lead"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("lead")).alias("pos"), "sym", "chars")
    return lent.unionByName(own), convs.select("conv_id")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, chars): what each turn's sequence from the first turn is known by."""
    hashes = (F.xxhash64("pos", "sym"), F.xxhash64("sym", "pos", F.lit(1)))
    rows = turns.select("conv_id", "pos", "chars", F.floor((F.col("pos") - 1) / BLOCK).alias("block"), *(h.alias(x) for h, x in zip(hashes, ("a", "b"))))
    sums = rows.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", *(F.bit_xor(x).over(earlier).alias(f"{x}_before") for x in "ab"))
    running = Window.partitionBy("conv_id", "block").orderBy("pos")
    rows = rows.select("conv_id", "block", "pos", "chars", *(F.bit_xor(x).over(running).alias(x) for x in "ab"))

    def whole(x: str) -> Column:
        return F.col(x).bitwiseXOR(F.coalesce(f"{x}_before", F.lit(0).cast("long")))

    rows = rows.join(sums.where("block > 0"), ["conv_id", "block"], "left")
    return rows.select("conv_id", F.col("pos").cast("long").alias("depth"), whole("a").alias("p1"), whole("b").alias("p2"), "chars")


def _ordered_nodes(turns: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with the key of their place in preorder, and (conv_id, depth, member) of every conversation's end."""
    rows = stored(_prefixes(turns), "trie-prefixes")
    same = ["depth", "p1", "p2"]
    nodes = stored(rows.groupBy(*same).agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")), "trie-nodes")
    runs = rows.join(nodes.select(*same, "rep"), same).groupBy("conv_id", "rep").agg(F.max("depth").alias("exit"))
    runs = stored(runs, "trie-runs")
    root = members.agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_convs")).first()
    first, nought = F.lit(root.rep).cast("long"), F.lit(0).cast("long")
    ends = runs.groupBy(F.col("conv_id").alias("member")).agg(F.max(F.struct("exit", "rep")).alias("e"))
    ends = members.select(F.col("conv_id").alias("member")).join(ends, "member", "left")
    ends = ends.select(F.coalesce("e.rep", first).alias("conv_id"), F.coalesce("e.exit", nought).alias("depth"), "member")
    # one entry for each chain on the way to a conversation's own
    steps = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("exit", "rep"))).alias("steps"))
    steps = steps.where(F.element_at("steps", -1)["rep"] == F.col("conv_id"))
    above = F.transform(F.slice("steps", 1, F.size("steps") - 1), lambda s: F.struct(s["rep"].alias("rep"), s["exit"].alias("exit")))
    chains = steps.select(F.col("conv_id").alias("rep"), above.alias("above"))
    held = nodes.select("rep", "depth", "n_convs", "chars").join(chains, "rep")
    last = F.when(F.size("above") > 0, F.element_at("above", -1))
    parent = F.when(F.col("depth") > F.coalesce(last["exit"], nought) + 1, F.col("rep")).otherwise(F.coalesce(last["rep"], first))
    held = held.select(F.concat("above", F.array(F.struct("rep", F.col("depth").alias("exit")))).alias("key"), "rep", "depth", parent.alias("parent"), "n_convs", "chars")
    top = [([], root.rep, 0, None, root.n_convs, 0)] if root.n_convs else []
    top = members.sparkSession.createDataFrame(top, "key array<struct<rep:long,exit:long>>, rep long, depth long, parent long, n_convs long, chars long")
    return stored(held.unionByName(top), "trie-order"), ends


def _encoded(nodes: DataFrame, shard_size: int) -> DataFrame:
    """The rows of every shard, as ``shard_nodes`` tells them."""
    shards = max(1, math.ceil(nodes.count() / shard_size))

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            numbers = {c: rows.column(c).to_numpy() for c in ("rep", "depth", "n_convs", "chars")}
            parent = rows.column("parent").combine_chunks()
            yield from shard_nodes(rows.column("shard")[0].as_py(), numbers["rep"], numbers["depth"], parent, numbers["n_convs"], numbers["chars"])

    dealt = nodes.repartitionByRange(shards, "key").sortWithinPartitions("key").withColumn("shard", F.spark_partition_id())
    return dealt.select("shard", "rep", "depth", "parent", "n_convs", "chars").mapInArrow(run, _SHARD)


def id_lists(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, digest): SHA-256 of each node's ends, as decimal ids in ascending order with commas between.

    Ids are put together in pieces of ``ENDS`` consecutive numbers; a node's pieces, sorted, then stream into
    one digest, so no list is ever held whole.
    """
    ids = F.transform(F.array_sort(F.collect_set("member")), lambda m: m.cast("string"))
    pieces = ends.groupBy("conv_id", "depth", F.floor(F.col("member") / ENDS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches):
        at, digest = None, None
        for batch in batches:
            out = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
                if at != (conv, depth):
                    if at:
                        out.append((*at, digest.hexdigest()))
                    at, digest = (conv, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "depth", "digest"), r)) for r in out], schema=schema)
        if at:
            yield pa.RecordBatch.from_pylist([dict(zip(("conv_id", "depth", "digest"), (*at, digest.hexdigest())))], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("digest", pa.string())])
    by_node = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "piece")
    return by_node.mapInArrow(run, "conv_id long, depth long, digest string")


def prefix_trie(turns: DataFrame, members: DataFrame, shard_size: int = SHARD_NODES) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, pos, sym, chars); ``members`` lists the conversations, turnless ones too.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    members = stored(members.select("conv_id").distinct(), "trie-members")
    nodes, ends = _ordered_nodes(turns, members)
    shards = stored(_encoded(nodes, shard_size), "trie-shards")
    names = _NAMES[3:10]
    open_nodes = shards.where(F.col("kind") != _DONE).drop("parens").repartition(1).sortWithinPartitions("shard", "kind", "seq")
    spines = open_nodes.mapInArrow(_merge_spines, ", ".join(f"{x} long" for x in names))
    settled = shards.where(F.col("kind") == _DONE).select(*names).unionByName(spines)
    return settled.join(id_lists(ends), ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op11_parenthesis_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stored(turn_symbols(table(spark, sf_dir, "conversations")), "trie-symbols")
    return prefix_trie(*rebuilt(turns))


#: The same nodes by joins: a node's subtree is what the smallest members of its nodes pass through it.
OP11_SQL = """
with kept as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
  from conversations where conv_id is not null
), ids as (
  select conv_id, count(*) as n,
    (xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
        lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint)) % 6 as h
  from kept group by conv_id
), sized as (
  select i.conv_id, i.h, i.conv_id - i.conv_id % 100 as base, least(i.h, coalesce(b.n, 0)) as lead
  from ids i left join ids b on b.conv_id = i.conv_id - i.conv_id % 100
), turns as (
  select s.conv_id, k.p as d, k.role, k.text from sized s join kept k on k.conv_id = s.base and k.p <= s.h
  union all
  select s.conv_id, k.p - s.h + s.lead, k.role, k.text from sized s join kept k on k.conv_id = s.conv_id and k.p > s.h
), paths as (
  select conv_id, d, length(text) as chars,
    sha256(string_agg(sha256(length(role)::varchar || ':' || role || text), ',') over (partition by conv_id order by d)) as path
  from turns
  union all select conv_id, 0, 0, '' from ids
), nodes as (
  select path, d, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars from paths group by path, d
), way as (
  select p.conv_id as member, p.d, n.conv_id, n.path from paths p join nodes n using (path, d)
), parents as (
  select n.path, w.conv_id as parent_conv_id, w.path as parent_path
  from nodes n left join way w on w.member = n.conv_id and w.d = n.d - 1
), children as (
  select parent_path as path, count(*) as n_children from parents where parent_path is not null group by 1
), below as (
  select w.path, sum((n.n_convs - 1) * n.chars) as saved, count(*) filter (where c.path is null) as leaves
  from nodes n left join children c using (path) join way w on w.member = n.conv_id and w.d <= n.d group by w.path
), ends as (
  select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, path from paths qualify row_number() over (partition by conv_id order by d desc) = 1) group by path
)
select n.conv_id::bigint as conv_id, n.d::bigint as depth, p.parent_conv_id::bigint as parent_conv_id, n.n_convs::bigint as n_convs,
  coalesce(c.n_children, 0)::bigint as n_children, b.leaves::bigint as n_leaves, b.saved::bigint as saved_tokens,
  sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join parents p using (path) left join children c using (path) join below b using (path) left join ends e using (path)
"""
