"""Each pipeline stage's rows against a brute force on a small fixture."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import AWKWARD, edited_items, prose

STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def kept_rows(docs, keep):
    return Counter(tuple(r) for r in docs.collect() if keep(r))


def test_toxicity_keeps_what_scores_below_a_half(spark, frame, tmp_path):
    disguises = [" idiot", " 1d10t", " i d i o t", " idiooot"]
    rows = [(i, prose(30) + (random.choice(disguises) if i % 4 == 0 else "")) for i in range(240)] + [(900, None), (901, ""), (902, "IDIOT, idio7!")]
    labels = {i: int(i % 4 == 0) for i, _ in rows if i < 900 and i % 3}
    spark.createDataFrame([(i, 1, t) for i, t in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(rows).repartition(3)
    # rows of the held-out fold are not learned from
    scores = brute.toxicity_scores(rows, {i: t for i, t in labels.items() if zlib.crc32(str(i).encode()) % 5})
    got = STAGES["toxicity"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert rows_of(got) == kept_rows(docs, lambda r: scores[r.doc_id] < 0.5)
    assert {r.doc_id for r in got.collect()} == {i for i, _ in rows if i >= 900 and i != 902 or i < 900 and i % 4}


def test_near_duplicates_keep_the_least_of_each_class(spark, frame):
    docs = frame(AWKWARD)
    got = [(r.doc_id, r.text) for r in STAGES["near_duplicates"](spark, docs, "").collect()]
    classes = brute.classes(AWKWARD)
    worded = {(i, t) for (i, t), (n, c) in zip(AWKWARD, classes) if n and i == c}
    assert Counter(got) == Counter(worded) + Counter(x for x, (n, _) in zip(AWKWARD, classes) if not n)


def test_decontamination_drops_what_holds_an_item(spark, frame, tmp_path):
    items = [(j, prose(random.choice([15, 20, 30, 45]))) for j in range(10)] + [(30, "the same words again " * 8), (31, "zebra crossing"), (32, None), (33, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = edited_items(items[:10], 12) + [(2, "the same words again " * 30), (3, None), (4, ""), (5, "a Zebra  crossing!"), (6, "zebra, no crossing")] + [(100 + i, prose(60)) for i in range(30)]
    rows += rows[:3]
    docs = frame(rows)
    got = STAGES["decontamination"](spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = rows_of(got)
    must = {i for i, _ in brute.similar_windows(rows, items)}
    lengths = {len(re.findall(r"[^\W_]+", x)) for _, x in items if x}
    may = {i for i, _ in brute.similar_windows(rows, items, lengths=lengths)}  # windows of other items' lengths too
    dropped = {r.doc_id for r in docs.collect()} - {r[0] for r in kept}
    assert must and must <= dropped <= may
    assert kept == kept_rows(docs, lambda r: r.doc_id not in dropped)


def test_mixing_takes_each_sources_target(spark, frame):
    rows = [(i, prose(random.randrange(1, 60)), "en", random.choice(["a", "b", "b", "c", "ä", None])) for i in range(500)]
    rows += [(900, None, "en", "a"), (901, "", "en", "empty"), (902, "x y", "en", "b"), (902, "x y", "en", "b")]
    docs = frame(rows)
    got = STAGES["mixing"](spark, docs, "")
    assert got.columns == docs.columns
    there, taken, copies = Counter(), Counter(), rows_of(got)
    held = rows_of(docs)
    for row, n in held.items():
        there[row[3]] += n * len(brute.WORD.findall(row[1] or ""))
    for row, n in copies.items():
        taken[row[3]] += n * len(brute.WORD.findall(row[1] or ""))
        assert n <= 3 * held[row]
    sources = sorted(there, key=lambda s: (s is None, s or ""))
    targets = brute.refilled([there[s] for s in sources], [(5, 2, 1)[i % 3] for i in range(len(sources))], 3.0)
    for source, target in zip(sources, targets):
        assert abs(taken[source] - target) <= 30, source
        # each row as often as target / size, rounded down or up
        if there[source]:
            times = target / there[source]
            assert all(int(times) * n <= copies[r] <= -(-target // there[source]) * n for r, n in held.items() if r[3] == source)
    assert rows_of(STAGES["mixing"](spark, frame(rows[::-1]).repartition(5), "")) == copies


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_sharding_places_every_row_once(spark, frame, n):
    rows = [(i // 2, prose(5) if i % 3 else None) for i in range(n)]
    got = STAGES["sharding"](spark, frame(rows), "").collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[s]) for s in range(corpus_pipeline.SHARDS)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
