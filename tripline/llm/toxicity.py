"""Toxicity by noisy-channel deobfuscation: decode disguised words, then score the restored text.

1. A character language model (byte trigrams) is counted over the whole corpus: every text of the table,
   dense counts by partition, summed by Spark.
2. Channel: a word's lattice has, at each character, the character itself and the letters it may stand
   for (fixed table below), a run of three or more equal letters may be one, two or all of them, and the
   separators of spaced-out letters may be dropped.  Viterbi under the language model picks the path.
   Decoded is every word with a digit or sign of the table beside a letter, its last character too, every
   word with a run of three equal letters, and every three or more letters with blanks, any number of them,
   or signs between.  The others have a single path, or stand for no letters (numbers, closing marks).
3. A classifier on 5-byte grams of the restored text, each known by its bytes: smoothed log odds of a
   gram's presence in toxic against other labelled texts, kept where the likelihood ratio is significant; a
   text's largest weight and the number of its telling grams go through a logistic curve.

Labels come from rows outside the held-out fold only; the classifier is fitted on at most ``SAMPLE``
labelled rows, drawn by hash.  The language model and the scoring cover all rows and whole texts.

Defined cases: null and empty texts have no telling gram and get the curve's base value; repeated rows
get equal scores; labels with null toxic are not learned from; several labels of one document count as
toxic when one is; without labels of both kinds the score is 0; texts of any length are scored whole, a
slice or one long text at a time; an empty table gives no rows; input columns named like the results are
not read, and ``drop_toxic`` keeps all columns as they are.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import crc_mod, table, text_batches, text_slices

#: Rows that the classifier is fitted on at most.
SAMPLE = 20_000
GRAM = 5
#: Bits of the table that says which grams to look up; grams are then compared by their bytes.
TABLE_BITS = 20
#: Grams of texts that a task holds before it adds them up.
PENDING = 1 << 19
#: A gram tells when its log odds and its likelihood ratio statistic reach these.
LEAST_ODDS, LEAST_G2 = 2.0, 25.0
# The letters that digits and signs stand for in disguised words.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Costs (negative log probabilities) of a disguise, of a sign that stands for itself, of a dropped separator, of a shortened run.
SUBSTITUTED, ITSELF, JOINED, SHORTENED = 0.5, 2.0, 0.3, 0.5

_CLASS = np.zeros(256, np.uint8)  # 0: blank or sign; 1 to 26: letters; 27: digits; 28 to 31: other bytes
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = 27
_CLASS[128:] = 28 + np.arange(128) % 4
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:48] = _FOLD[58:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in STANDS_FOR]] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
#: Characters that end a disguised word; other signs there are closing marks.
_TAIL = np.zeros(256, bool)
_TAIL[[*range(48, 58), ord("@"), ord("$")]] = True
_BLANKS = re.compile(r"[\x09-\x0d ]+")
_EDGES = re.compile(r"^[^\w@$!|+]+|[^\w@$]+$")


def language_model(documents: DataFrame) -> np.ndarray:
    """Log probability of a byte class after the two before it, from every text of the table (32**3 numbers)."""

    def count(batches):
        total = np.zeros(1 << 15, np.int64)
        for batch in batches:
            for _, _, data, _ in text_slices(batch.column("text")):
                c = _CLASS[data].astype(np.int32)
                if len(c) > 2:
                    total += np.bincount(c[:-2] << 10 | c[1:-1] << 5 | c[2:], minlength=1 << 15)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    counts = text_batches(documents).select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    held = np.full(1 << 15, 0.1)
    held[counts["gram"].to_numpy(int)] += counts["n"].to_numpy(float)
    held = held.reshape(32, 32, 32)
    return np.log(held / held.sum(2, keepdims=True))


def _choices(text: str) -> list[list[tuple[str, float]]]:
    """The lattice: for each run of equal characters the strings it may stand for, with their costs."""
    out = []
    spaced = len(text) > 2 and all(len(p) == 1 for p in re.split(r"[ .\-_*]", text) if p)
    for run in re.finditer(r"(.)\1*", text, re.S):
        c, n = run.group(1), len(run.group())
        arcs = [(run.group(), 0.0)]
        if c in STANDS_FOR:
            arcs = [(run.group(), ITSELF * n)] + [(x * m, SUBSTITUTED) for x in STANDS_FOR[c] for m in {1, n}]
        elif n >= 3 and c.isalpha():
            arcs += [(c, SHORTENED), (c * 2, SHORTENED)]
        elif spaced and c in " .-_*":
            arcs.append(("", JOINED))
        out.append(arcs)
    return out


def decode(text: str, model: np.ndarray) -> str:
    """The likeliest original of a disguised stretch of lower-case text."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for arcs in [*_choices(text), [(" ", 0.0)]]:
        reached: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in states.items():
            for piece, price in arcs:
                x, y, total = a, b, cost + price
                for byte in piece.encode():
                    z = int(_CLASS[byte])
                    total -= model[x, y, z]
                    x, y = y, z
                if (x, y) not in reached or total < reached[x, y][0]:
                    reached[x, y] = (total, (path, piece))
        states = reached
    path = min(states.values(), key=lambda s: s[0])[1]
    pieces = []
    while path:
        path, piece = path
        pieces.append(piece)
    return "".join(pieces[:0:-1])


def _disguised(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of words whose lattice has more than one path, and of stretches of spaced-out letters."""
    if not len(data):
        return []
    letter, leet, blank = _LETTER[data], _LEET[data], (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~blank
    before = np.concatenate(([True], blank[:-1])) | edge[:-1]
    after = np.concatenate((blank[1:], [True])) | edge[1:]
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    mark = np.zeros(len(data) + 1, np.int32)
    hit = np.zeros(len(data), bool)
    hit[:-1] = leet[:-1] & letter[1:]
    hit[1:] |= leet[1:] & letter[:-1] & (_TAIL[data[1:]] | np.concatenate((letter[2:] | leet[2:], [False])))
    hit[2:] |= letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 128)
    np.cumsum(hit, out=mark[1:])
    odd = mark[ends] > mark[starts]
    size = ends - starts
    lead = data[starts]
    single = ((size == 1) | ((size == 2) & (lead >= 0xC2) & (lead < 0xE0))) & (letter[starts] | leet[starts])
    # letters with blanks between, three or more in a row
    texts = np.searchsorted(offsets, starts, "right")
    linked = np.zeros(len(starts) + 1, bool)
    linked[1:-1] = single[1:] & single[:-1] & (texts[1:] == texts[:-1])
    heads = np.flatnonzero(single & ~linked[:-1])
    tails = np.flatnonzero(single & ~linked[1:])
    long = tails - heads >= 2
    ranges = [(int(starts[a]), int(ends[b])) for a, b in zip(heads[long], tails[long])]
    inside = np.zeros(len(starts) + 1, np.int32)
    np.add.at(inside, heads[long], 1)
    np.add.at(inside, tails[long] + 1, -1)
    # letters with a sign between them within one word, like i.d.i.o.t
    signs = np.isin(data, np.frombuffer(b".-_*", np.uint8))
    mark2 = np.zeros(len(data) + 1, np.int32)
    np.cumsum(signs, out=mark2[1:])
    odd |= (mark2[ends] - mark2[starts] >= 2) & (2 * (mark2[ends] - mark2[starts]) >= size - 2)
    odd &= np.cumsum(inside)[:-1] == 0
    return sorted(ranges + [(int(a), int(b)) for a, b in zip(starts[odd], ends[odd])])


def restore(texts: list[str | None], model: np.ndarray, decoder=None) -> list[str]:
    """Lower-cased texts with every disguised stretch decoded."""
    decoder = decoder or functools.partial(decode, model=model)
    column = pa.array([(t or "").lower() for t in texts], pa.large_string())
    out: list[str] = []
    for first, end, data, offsets in text_slices(column):
        raw = data.tobytes()
        ranges = _disguised(data, offsets)
        owners = np.searchsorted(offsets, [a for a, _ in ranges], "right") - 1
        at = 0
        for row in range(end - first):
            pos, stop, pieces = int(offsets[row]), int(offsets[row + 1]), []
            while at < len(ranges) and owners[at] == row:
                a, b = ranges[at]
                stretch = raw[a:b].decode("utf-8", "replace")
                core = _EDGES.sub("", _BLANKS.sub(" ", stretch))
                pieces += [raw[pos:a].decode("utf-8", "replace"), " ", decoder(core), " "]
                pos, at = b, at + 1
            pieces.append(raw[pos:stop].decode("utf-8", "replace"))
            out.append("".join(pieces))
    return out


def _grams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, the gram's bytes as a number at each byte, row of each byte) of restored texts with blanks at both ends."""
    column = pa.array([f" {t} " for t in texts], pa.large_string())
    for first, end, data, offsets in text_slices(column):
        x, low = np.zeros(max(len(data) - GRAM + 1, 0), np.int64), _FOLD[data].astype(np.int64)
        for j in range(GRAM):
            x = (x << 8) | low[j : j + len(x)]
        owners = np.repeat(np.arange(end - first), np.diff(offsets))
        rows = owners[: len(x)]
        keep = rows == owners[GRAM - 1 :]
        yield first, end, x[keep], rows[keep]


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Weights:
    """Weights of the telling grams, which are as many as the sample holds at most."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.weights = grams[order], weights[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[_slot(self.grams)] = True

    def __call__(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the telling ones among some grams, and their weights."""
        at = np.flatnonzero(self.table[_slot(grams)])
        place = np.searchsorted(self.grams, grams[at])
        same = self.grams[np.minimum(place, len(self.grams) - 1)] == grams[at] if len(at) else np.zeros(0, bool)
        return at[same], self.weights[place[same]]


def _evidence(texts: list[str], weights: Weights) -> np.ndarray:
    """For each text its largest gram weight and log(1 + telling grams)."""
    out = np.zeros((len(texts), 2))
    for first, end, grams, rows in _grams(texts):
        at, held = weights(grams)
        top = np.zeros(end - first)
        np.maximum.at(top, rows[at], held)
        out[first:end, 0] = top
        out[first:end, 1] = np.log1p(np.bincount(rows[at], minlength=end - first))
    return out


def _added(pending: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (gram, clean, toxic) with each gram once."""
    if not any(map(len, pending)):
        return []
    rows = np.concatenate(pending)
    rows = rows[np.argsort(rows[:, 0], kind="stable")]
    first = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
    return [np.column_stack([rows[first, 0], np.add.reduceat(rows[:, 1:], first)])]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve (last: base), by Newton steps with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([0.5] * (len(w) - 1) + [1e-6])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Language model from all documents; classifier from at most ``sample`` of the labelled rows given."""
    spark = documents.sparkSession
    chars = spark.sparkContext.broadcast(language_model(documents))  # 32**3 numbers
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, sample / max(n, 1))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about `sample` rows of two numbers
    rows = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches):
        decoder = functools.lru_cache(1 << 16)(functools.partial(decode, model=chars.value))
        pending, size = [], np.zeros(2, np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for first, end, grams, owners in _grams(restore(batch.column("text").to_pylist(), chars.value, decoder)):
                pairs = np.unique(owners << 8 * GRAM | grams)
                mine = toxic[first:end][pairs >> 8 * GRAM]
                pending.append(np.column_stack([pairs & ((1 << 8 * GRAM) - 1), ~mine, mine]).astype(np.int64))
                if sum(map(len, pending)) > PENDING:
                    pending = _added(pending)
            size += np.bincount(toxic, minlength=2)
        rows = np.concatenate([*_added(pending), [[-1, *size]]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T.copy()], names=["gram", "clean", "toxic"])

    grams = (
        rows.mapInArrow(count, "gram long, clean long, toxic long")
        .groupBy("gram")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where("gram = -1 or toxic >= 5")
        .toPandas()
    )  # grams of five toxic rows of the sample, at most
    total = grams[grams["gram"] == -1]
    n_clean, n_toxic = (int(total["clean"].sum()), int(total["toxic"].sum())) if len(total) else (0, 0)
    if not n_clean or not n_toxic:
        return {"chars": chars, "weights": None, "curve": None}
    grams = grams[grams["gram"] >= 0]
    a, b = grams["toxic"].to_numpy(float), grams["clean"].to_numpy(float)
    odds = np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_clean + 1))
    share_all = (a + b) / (n_clean + n_toxic)
    with np.errstate(divide="ignore", invalid="ignore"):
        g2 = 2 * (np.where(a > 0, a * np.log(a / (n_toxic * share_all)), 0) + np.where(b > 0, b * np.log(b / (n_clean * share_all)), 0))
    telling = (odds >= LEAST_ODDS) & (g2 >= LEAST_G2)
    weights = Weights(grams["gram"].to_numpy(np.int64)[telling], odds[telling])
    fitted = {"chars": chars, "weights": spark.sparkContext.broadcast(weights), "curve": None}  # 2**TABLE_BITS bits and the sample's grams
    seen = rows.withColumn("e", evidence_of(F.col("text"), fitted)).select("toxic", "e.*").toPandas()  # at most about `sample` rows
    fitted["curve"] = _logistic(seen[["top", "many"]].to_numpy(), seen["toxic"].to_numpy(float))
    return fitted


def evidence_of(text: Column, model: dict) -> Column:
    """struct<top, many> of each text."""
    chars, weights = model["chars"], model["weights"]

    @F.pandas_udf("top double, many double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decoder = functools.lru_cache(1 << 16)(functools.partial(decode, model=chars.value))
        for batch in batches:
            yield pd.DataFrame(_evidence(restore(list(batch), chars.value, decoder), weights.value), columns=["top", "many"])

    return evidence(F.coalesce(text, F.lit("")))


def score_of(text: Column, model: dict) -> Column:
    """Score of each text, 0 to 1."""
    if model["curve"] is None:
        return F.lit(0.0)
    e, (top, many, base) = evidence_of(text, model), (float(x) for x in model["curve"])
    return 1 / (1 + F.exp(-(e["top"] * top + e["many"] * many + base)))


def score_documents(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted of every row."""
    scored = text_batches(documents).select("doc_id", score_of(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of documents, all columns, whose score is below the threshold."""
    model = train(documents, labels.where(crc_mod("doc_id", 5) != 0))
    return documents.where(score_of(F.col("text"), model) < threshold)


def op2_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_mod("doc_id", 5) != 0))
    return score_documents(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
