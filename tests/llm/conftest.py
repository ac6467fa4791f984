from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns named like operators' results."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]), 9.0, 99) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
