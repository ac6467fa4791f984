from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripline.llm import fillmiddle, prefixtrie, topk

# conversation prefix trie


def brute_trie(rows, group=100, most=6):
    """Nodes of the rebuilt conversations, each subtree walked."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in turns.items()}
    full = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % most
        full[c] = tuple(turns.get(c - int(math.fmod(c, group)), [])[:h] + turns[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in full.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)

    def walk(seq):
        leaves, saved = int(not children[seq]), (len(members[seq]) - 1) * (len(seq[-1][1]) if seq else 0)
        for x in children[seq]:
            a, b = walk(x)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    return {
        (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), *walk(s), hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())
        for s, m in members.items()
    }


def chats(seed, n, ids=300):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "first"), (7, 3, "user", "same"), (7, 3, "user", "same"), (-5, 0, "a", "b")]
    lines = ["", "hi", "äö 漢", "what is it?", "x" * 300]
    for _ in range(n):
        c = rng.choice([rng.randrange(ids), 0, 100, 200])
        rows.append((c, rng.randrange(30), rng.choice(["user", "assistant", None]), rng.choice(lines)))
    same = [(t, "user", "copy") for t in range(9)]
    rows += [(c, *x) for c in range(400, 480) for x in same[: 3 + c % 7]]
    rows += [(900, t, "user", f"long {t}") for t in range(120)] + [(901, t, "user", f"long {t}") for t in range(90)]
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,n,shard,block", [(1, 0, 7, 4), (2, 600, 50, 4), (3, 900, 1 << 16, 4096)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, n, shard, block):
    monkeypatch.setattr(prefixtrie, "BLOCK", block)
    monkeypatch.setattr(prefixtrie, "ENDS", 3 if block == 4 else 4096)
    rows = chats(seed, n)
    conversations = spark.createDataFrame(rows, CONVERSATIONS).withColumns({"depth": F.lit("x"), "rep": F.lit(1), "n": F.lit(2)})
    turns = prefixtrie.stored(prefixtrie.turn_symbols(conversations.repartition(5)), "test")
    got = prefixtrie.prefix_trie(*prefixtrie.rebuilt(turns), shard_size=shard).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == brute_trie(rows)


def test_trie_of_no_rows(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    turns = prefixtrie.turn_symbols(empty)
    assert prefixtrie.prefix_trie(*prefixtrie.rebuilt(turns)).count() == 0


def test_trie_of_turnless_conversations(spark):
    rows = [(c, 0, "user", "only") for c in (101, 102, 103, 104)]
    turns = prefixtrie.stored(prefixtrie.turn_symbols(spark.createDataFrame(rows, CONVERSATIONS)), "test")
    assert {tuple(r) for r in prefixtrie.prefix_trie(*prefixtrie.rebuilt(turns)).collect()} == brute_trie(rows)


@pytest.mark.parametrize("seed", range(6))
def test_find_close_matches_a_stack(seed):
    rng = random.Random(seed)
    depths = [rng.randrange(5)]
    for _ in range(rng.choice([1, 50, 3000])):
        depths.append(rng.randrange(max(0, depths[-1] - rng.choice([1, 1, 40])), depths[-1] + 2))
    tree = prefixtrie.Parentheses(np.array(depths))
    want, stack = {}, []
    for place, opened in enumerate(tree.bits):
        if opened:
            stack.append(place)
        else:
            want[stack.pop()] = place
    assert [want.get(int(p), -1) for p in tree.opens] == tree.find_close().tolist()


# fill-in-the-middle


def test_fim_round_trip_in_any_pieces():
    text = "<<P<S a<M ><P >>< S>äö漢字" * 9
    for form in fillmiddle.ORDER:
        for a, b in [(0, 0), (0, 40), (17, 17), (31, 80), (len(text), len(text))]:
            a, b = (len(text), len(text)) if form == "plain" else (a, b)
            for size in (1, 2, 7, 4096):
                output = "".join(fillmiddle.pieces_of(text, form, a, b, size))
                for step in (1, 2, 5, 10_000):
                    reader, parts = fillmiddle.Reader(form), defaultdict(str)
                    for at in range(0, len(output), step):
                        for part, piece in reader.feed(output[at : at + step]):
                            parts[part] += piece
                    for part, piece in reader.feed("", last=True):
                        parts[part] += piece
                    assert parts[0] + parts[1] + parts[2] == text
                    if form != "plain":
                        assert (parts[0], parts[1]) == (text[:a], text[a:b])


def brute_fim(doc_id, text):
    text = text or ""
    n, digest = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or h[2] % 100 >= 90 or any(s in text for s in ("<P>", "<S>", "<M>")):
        form, output, a, b = "plain", text, None, None
    elif h[3] % 100 < 20:
        form, output = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    else:
        form, output = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    return doc_id, n, form, a, None if a is None else b - a, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("size", [3, fillmiddle.PIECE])
def test_fim_equals_brute_force(spark, frame, size):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("ab <>PSM漢é\n", k=rng.choice([0, 1, 2, 50, 400])))) for i in range(120)]
    rows += [(5, None), (6, ""), (None, "no id"), (None, None), (7, "has <S> in it"), (8, "long " * 20_000)]
    rows += [(9, "copy")] * 40 + [(10, "same id, one"), (10, "same id, other")]
    got = fillmiddle.fill_in_middle(frame(rows).repartition(6), size=size).collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute_fim(*r) for r in rows), key=str)


def test_fim_of_no_rows(frame):
    assert fillmiddle.fill_in_middle(frame([])).count() == 0


def test_fim_outputs_are_whole_and_in_turn(frame):
    rows = [(i, f"text {i} " * 300) for i in range(20)]
    pieces = fillmiddle.assembled(frame(rows), size=100).where("place >= 0").orderBy("doc_id", "place").collect()
    held = defaultdict(str)
    for r in pieces:
        held[r.doc_id] += r.piece
    assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in held.items()} == {i: brute_fim(i, t)[5] for i, t in rows}


# exact top-k


def brute_top(rows, k=10, every=100, scale=1024):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * float(np.float32(x))) for x in v]

    held = {(i, tuple(v)) for i, v in ((i, whole(v)) for i, v in rows) if i is not None and v is not None}
    out = set()
    for i, q in held:
        if i % every == 0:
            found = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -(1 << 63)), (1 << 63) - 1), j) for j, v in held if (j, v) != (i, q))
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])}
    return out


VECTORS = "vec_id long, embedding array<float>, score string, cell int, key int"


@pytest.mark.parametrize("pivots,tile,visits", [(64, 16_384, 1 << 17), (6, 7, 2), (1, 1000, 1)])
def test_top_k_equals_brute_force(spark, pivots, tile, visits):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.1 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[100][1]) for i in range(150)]
    rows += [(600, rows[3][1]), (600, rows[3][1]), (601, None), (602, [1.0, None]), (603, [float("nan")] * 8), (604, [float("inf")] + [0.0] * 7)]
    rows += [(None, rows[5][1]), (605, []), (606, [0.5, 0.25]), (700, [0.0] * 8), (800, [1e18] * 8), (801, [-1e18] * 8), (802, [3e4] * 8), (-100, rows[9][1])]
    frame = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS).repartition(4)
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0, pivots=pivots, tile=tile, visits=visits).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == brute_top(rows)


def test_top_k_of_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0], "", 0, 0), (1, [2.0], "", 0, 0)], VECTORS)
    assert {tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 0).collect()} == {(0, 1, 1, 2 << 20)}
    assert topk.top_k(frame.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(frame, F.col("vec_id") > 9).count() == 0


def test_clustered_vectors_visit_few_cells(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 3
    rows = [(i, (centres[i % 40] + 0.02 * rng.normal(size=16)).tolist(), "", 0, 0) for i in range(4000)]
    frame = spark.createDataFrame(rows, VECTORS)
    entries = topk.entries_of(topk.quantised(frame), 10)
    points = np.array([r.vec for r in entries.orderBy(F.xxhash64("key")).limit(64).collect()])
    celled = topk._celled(entries, points)
    known = topk.summarise(celled, points, 10)
    queries = entries.orderBy("key").limit(200)
    assert topk._visits(queries, known, 10).count() < 200 * (known.size > 0).sum() / 4
