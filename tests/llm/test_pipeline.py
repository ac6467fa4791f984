from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from tests.llm import brute
from tripline.llm import registry


def test_every_operator_has_a_query():
    assert [k.split("_")[0] for k in registry.QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_match_sql(spark, small, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        db.sql(f"create view {table} as from '{small}/{table}.parquet'")
    want = db.sql(registry.SQL[name]).df()
    got = registry.QUERIES[name](spark, small).toPandas()
    key = list(want.columns[:2])
    a, b = (x.sort_values(key).reset_index(drop=True).astype(object).fillna("null") for x in (got[want.columns], want))
    assert a.equals(b)


def test_stages_keep_columns_and_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, docs, small), f"test-{name}")
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in docs.collect()]
            assert {r.doc_id for r in out.collect()} == {c for _, c in brute.classes(rows)}
        if name == "sharding":
            slots = {}
            for r in out.collect():
                slots.setdefault(r.shard, []).append(r.slot)
            assert all(sorted(v) == list(range(len(v))) for v in slots.values())
            assert out.count() == docs.count()
        else:
            assert out.columns == docs.columns
        docs = out
        sizes.append(out.count())
    assert sizes[0] >= sizes[1] > sizes[2] >= sizes[3] > 0


def test_stages_handle_awkward_rows(spark, frame, small):
    docs = frame([(1, None), (2, ""), (2, ""), (None, "one two"), (3, "x " * 5000)])
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, small), f"test-{name}")
        assert docs.count() >= 0
    empty = frame([])
    for name, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.stored(stage(spark, empty, small), f"test-{name}")
        assert empty.count() == 0
