"""Columns named like results are not read: rows are those of the plain columns."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import AWKWARD
from tripline.llm import decontaminate, language, licenses, ngramjoin, suffixdedup, urlfilter

NAMES = (
    "thash", "n_shingles", "class_id", "component_id", "digest", "n", "grp", "token", "whole_license", "notice_licenses", "n_notices", "lines",
    "tid", "kept", "removed", "n_bytes", "lang_pred", "n_spans", "words", "hash", "item_id", "similarity", "start_word", "start", "length", "host", "path", "rule", "verdict",
)


def widened(df):
    """The rows with columns of the results' names, of another type."""
    return df.select("*", *(F.lit(f"not {n}").alias(n) for n in NAMES if n not in df.columns))


def rows(df):
    return Counter(map(str, df.collect()))


@pytest.mark.parametrize("name", ["classes", "licenses", "repeats", "language", "leaks"])
def test_documents(spark, frame, name):
    docs = frame([r for r in AWKWARD if r[0] is None or r[0] < 24] + [(90, "Released under the MIT License.")]).select("doc_id", "text", "lang")
    items = spark.createDataFrame([(1, AWKWARD[6][1]), (2, "one two three"), (None, None)], "item_id long, text string")
    run = {
        "classes": ngramjoin.similarity_classes,
        "licenses": lambda d: licenses.scan_licenses(d, licenses.known_digests(spark)),
        "repeats": lambda d: suffixdedup.remove_repeats(d, 50),
        "language": lambda d: language.identify(d, language.train(d)),
        "leaks": lambda d: decontaminate.find_leaks(d, items if d is docs else widened(items)),
    }[name]
    want = rows(run(docs))
    assert want and rows(run(widened(docs))) == want


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://example.net/en/x"), (2, None), (None, "http://a.org/fr/"), (3, "http://net/"), (3, "http://net/")], "page_id long, url string")
    assert rows(urlfilter.judge_urls(widened(pages))) == rows(urlfilter.judge_urls(pages))
