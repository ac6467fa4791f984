"""Language of whole texts: script ranges narrow the candidates of each word, Viterbi labels spans.

A model holds, for each language of the training rows, log probabilities of hashed byte 4-grams and the
share of its words by script.  A word's score is the sum over its 4-grams, one blank on either side
included; a language that does not use the word's script is out.  Viterbi with a switching penalty over
a document's words gives the spans.  The predicted language is the one with most letters (bytes) in its
spans; ``score`` is its share of them.

Defined cases: null text, empty text and text without a letter give ``und`` and score 0; so does every
text when no row can be learned from; ties go to the first language in code point order; rows with null
lang are not learned from; an empty table gives no rows; a very long text is labelled whole, as a slice of
its own; columns but doc_id, text and (to learn) lang are not read, so documents may have a column named
score or lang_pred.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import crc_mod, table, text_batches, text_slices

GRAM, FEATURES, SCRIPTS = 4, 1 << 16, 16
#: Log-likelihood that a change of language between two words costs.
SWITCH = 12.0
#: A script belongs to a language when it has at least this share of its words.
SCRIPT_SHARE = 1e-3
SLICE = 4 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
#: Script by the lead byte of a letter: ASCII and accented Latin share one; the rest by UTF-8 range.
_SCRIPT = np.zeros(256, np.uint8)
for _i, (_a, _b) in enumerate(
    [(0xCD, 0xCF), (0xD0, 0xD4), (0xD5, 0xD5), (0xD6, 0xD7), (0xD8, 0xDB), (0xDC, 0xDF), (0xE0, 0xE0), (0xE1, 0xE1), (0xE2, 0xE2), (0xE3, 0xE3), (0xE4, 0xE9), (0xEA, 0xED), (0xEE, 0xEF), (0xF0, 0xF4)],
    start=1,
):
    _SCRIPT[_a : _b + 1] = _i
_LETTER = re.compile(r"[^\W\d_]")


def _folded(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of lower-cased bytes in which all but letters are blanks and each row ends in a blank."""
    lowered = pa.array([f" {(t or '').lower()} " for t in column.to_pylist()], pa.large_string())
    for first, end, data, offsets in text_slices(lowered, SLICE):
        yield first, end, _FOLD[data], offsets


def _grams(data: np.ndarray) -> np.ndarray:
    """Hashed 4-gram that starts at each byte; the last three positions are dropped."""
    x = np.zeros(max(len(data) - GRAM + 1, 0), np.uint32)
    for j in range(GRAM):
        x = x * np.uint32(0x01000193) ^ data[j : len(data) - GRAM + 1 + j]
    x *= np.uint32(0x9E3779B1)
    return (x >> np.uint32(16)).astype(np.int64)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and script of each word."""
    letter = data != 32
    step = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    starts, ends = step[::2], step[1::2]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, _SCRIPT[data[starts]]


def train(rows: DataFrame) -> dict:
    """Model from (text, lang) rows: counts over all of them, summed by Spark; languages x 2**16 numbers reach the driver."""

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for first, end, data, offsets in _folded(batch.column("text")):
                grams = _grams(data)
                starts, _, owners, scripts = _words(data, offsets)
                for lang in set(langs[first:end]):
                    held = total.setdefault(lang, np.zeros(FEATURES + SCRIPTS, np.int64))
                    mine = langs[first:end] == lang
                    for row in np.flatnonzero(mine):
                        part = grams[offsets[row] : offsets[row + 1] - GRAM + 1]
                        held[:FEATURES] += np.bincount(part, minlength=FEATURES) if len(part) > 20_000 else 0
                        if len(part) <= 20_000:
                            np.add.at(held, part, 1)
                    held[FEATURES:] += np.bincount(scripts[mine[owners]], minlength=SCRIPTS)
        for lang, held in total.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(held[at])], names=["lang", "feature", "n"]
            )

    counts = (
        text_batches(rows).where("lang is not null and text is not null")
        .select("text", "lang")
        .mapInArrow(count, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(counts["lang"].unique())
    held = np.zeros((FEATURES + SCRIPTS, len(langs)))
    held[counts["feature"].to_numpy(int), [langs.index(x) for x in counts["lang"]]] = counts["n"]
    grams, scripts = held[:FEATURES], held[FEATURES:]
    logp = np.log(grams + 0.5) - np.log(grams.sum(0) + 0.5 * FEATURES)
    shares = scripts / np.maximum(scripts.sum(0), 1)
    out = (shares < SCRIPT_SHARE) & (shares.max(1, keepdims=True, initial=0) >= SCRIPT_SHARE)
    return {"langs": langs, "logp": logp.astype(np.float32), "out": np.where(out, -1e4, 0.0)}


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word: rows of ``scores`` are the words of all documents in turn, ``counts`` words by document.

    One step handles the t-th word of every document, longest documents first, so the work of a
    step shrinks with the documents that are still going.
    """
    n_langs = scores.shape[1]
    best = np.zeros(len(scores), np.int64)
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    firsts = (np.cumsum(counts) - counts)[order]
    if not len(lengths) or not lengths[0]:
        return best
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    value = np.zeros((len(counts), n_langs))
    back = np.zeros((len(scores), n_langs), np.int8 if n_langs < 128 else np.int16)
    own = np.arange(n_langs)
    for t in range(lengths[0]):
        k = active[t]
        at, v = firsts[:k] + t, value[:k]
        top = v.argmax(1)
        jump = v[np.arange(k), top][:, None] - switch
        move = v < jump
        back[at] = np.where(move, top[:, None], own)
        value[:k] = np.where(move, jump, v) + scores[at]
    state = value.argmax(1)
    for t in range(lengths[0] - 1, -1, -1):
        k = active[t]
        at = firsts[:k] + t
        best[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return best


def _spans(column: pa.Array, model: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row, start, end, language) of the words of each slice."""
    for first, end, data, offsets in _folded(column):
        starts, ends, owners, scripts = _words(data, offsets)
        grams = _grams(data)
        scores = np.empty((len(starts), len(model["langs"])))
        for lang in range(scores.shape[1]):
            sums = np.zeros(len(grams) + 1)
            np.cumsum(model["logp"][grams, lang], out=sums[1:], dtype=np.float64)
            last = np.minimum(np.maximum(ends - GRAM + 2, starts), len(grams))
            scores[:, lang] = sums[last] - sums[np.minimum(starts - 1, last)]
        scores += model["out"][scripts]
        yield first, end, owners, starts, ends, viterbi(scores, np.bincount(owners, minlength=end - first))


def label_spans(texts: list[str], model: dict) -> list[list[tuple[str, int]]]:
    """For each text its spans in turn: (language, letters in bytes)."""
    out: list[list[tuple[str, int]]] = [[] for _ in texts]
    for first, _, owners, starts, ends, best in _spans(pa.array(texts, pa.large_string()), model):
        for row, size, lang in zip(owners + first, ends - starts, best):
            name = model["langs"][lang]
            if out[row] and out[row][-1][0] == name:
                out[row][-1] = (name, out[row][-1][1] + int(size))
            else:
                out[row].append((name, int(size)))
    return out


def identify(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, n_spans for every row."""
    spark = documents.sparkSession
    documents = text_batches(documents)
    held = spark.sparkContext.broadcast(model)  # languages x 2**16 numbers

    def run(batches):
        model = held.value
        langs = np.array([*model["langs"], "und"], object)
        for batch in batches:
            n, text = batch.num_rows, batch.column("text")
            pred, score, spans = np.full(n, len(langs) - 1), np.zeros(n), np.zeros(n, np.int64)
            if len(langs) > 1:
                for first, end, owners, starts, ends, best in _spans(text, model):
                    size = np.zeros((end - first, len(langs) - 1))
                    np.add.at(size, (owners, best), ends - starts)
                    pred[first:end] = size.argmax(1)
                    score[first:end] = size.max(1) / np.maximum(size.sum(1), 1)
                    if len(owners):
                        new = np.ones(len(owners), bool)
                        new[1:] = (owners[1:] != owners[:-1]) | (best[1:] != best[:-1])
                        spans[first:end] = np.bincount(owners[new], minlength=end - first)
            silent = np.array([not t or not _LETTER.search(t) for t in text.to_pylist()], bool)
            pred[silent], score[silent], spans[silent] = len(langs) - 1, 0.0, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(langs[pred]), pa.string()), pa.array(score), pa.array(spans)],
                names=["doc_id", "lang_pred", "score", "n_spans"],
            )

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_spans long")


def op8_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(crc_mod("doc_id", 4) != 2))
    found = identify(docs, model)
    return found.withColumn("held_out", crc_mod("doc_id", 4) == 2)
