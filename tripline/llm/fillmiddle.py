"""Fill-in-the-middle: texts cut in three and put together anew by a secondary sort.

1. Every text is cut at two places, drawn from a digest of its id, into prefix, middle and suffix, and the
   three leave as pieces of at most ``PIECE`` code points, keyed by document and by their place in the
   output; a sentinel goes in front of its part's first piece.
2. Pieces are repartitioned by document and sorted by place inside partitions.  A pass over the sorted
   stream feeds each document's output, piece by piece, to its digest; no document is ever held whole.
3. The same pass reads the output as any reader would: it looks for the sentinels in the stream, across
   pieces too, and keys what lies between by the place that it has in the original.  A second sort inside
   the partition, without a shuffle, brings that order, and a pass over it gives the restored text's digest.

A document's key is its id and a 128-bit digest of its text.  Rows equal in both are counted where they are
read, in each batch, and again where they meet; their pieces go through once and the row comes as often as
it was counted.

Defined cases: null text counts as empty; a null id is drawn for as the empty text; empty texts, and those
that hold a sentinel, stay plain; texts may be of any length; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import table, text_batches

# Fixed values of the transformation: sentinels, and the shares of a hundred that are changed and that put the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED, SUFFIX_FIRST = 90, 20
#: Code points of a piece, at most.
PIECE = 4096
#: Parts of a text in the order of the original.
_BEFORE, _INSIDE, _AFTER = range(3)
#: Parts of the output of each form, in turn: the sentinel in front and the part of the original; sentinels stand for no text of their own.
ORDER = {
    "plain": [("", _BEFORE)],
    "psm": [(PREFIX, _BEFORE), (SUFFIX, _AFTER), (MIDDLE, _INSIDE)],
    "spm": [(SUFFIX, _AFTER), (PREFIX, _BEFORE), (MIDDLE, _INSIDE)],
}


def plan(doc_id: int | None, text: str) -> tuple[str, int, int]:
    """(form, code points before the middle, code points before the suffix) of a text."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or h3 % 100 >= CHANGED or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", len(text), len(text)
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    return ("spm" if h4 % 100 < SUFFIX_FIRST else "psm"), a, b


def pieces_of(text: str, form: str, a: int, b: int, size: int = PIECE) -> Iterator[str]:
    """The output in turn, each piece of at most ``size`` code points and the sentinel in front of it."""
    spans = {_BEFORE: (0, a), _INSIDE: (a, b), _AFTER: (b, len(text))}
    for sentinel, part in ORDER[form]:
        start, end = spans[part]
        if start == end:
            yield sentinel
        for at in range(start, end, size):
            yield (sentinel if at == start else "") + text[at : min(at + size, end)]


class Reader:
    """Splits a stream of output into the parts of the original: ``feed`` gives (part, text) as far as it is certain."""

    def __init__(self, form: str):
        self.order = [(s, part) for s, part in ORDER[form] if s]
        self.part = None if self.order else _BEFORE
        self.held = ""

    def feed(self, text: str, last: bool = False) -> Iterator[tuple[int, str]]:
        self.held += text
        while self.order and (at := self.held.find(self.order[0][0])) >= 0:
            if self.part is not None and at:
                yield self.part, self.held[:at]
            sentinel, self.part = self.order.pop(0)
            self.held = self.held[at + len(sentinel) :]
        # the next sentinel may have begun
        keep = 0 if last or not self.order else min(len(self.held), len(self.order[0][0]) - 1)
        ready, self.held = self.held[: len(self.held) - keep], self.held[len(self.held) - keep :]
        if ready and self.part is not None:
            yield self.part, ready


_KEY = "doc_id long, thash binary"
_PIECES = f"{_KEY}, place int, n long, form string, prefix_chars long, middle_chars long, copies long, piece string"
_PARTS = f"{_KEY}, part int, place int, n long, form string, prefix_chars long, middle_chars long, copies long, output_sha256 string, piece string"
_RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


class _Rows:
    """Rows that leave as Arrow batches of about ``PIECE`` rows or a few MB."""

    def __init__(self, columns: str):
        self.schema = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in columns.split(", ")])
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= 1 << 21:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)]
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.size = [], 0


def emit_pieces(documents: DataFrame, planned: Callable = plan, size: int = PIECE) -> DataFrame:
    """Pieces of every text's output; place -1 is the document's row of facts, with the copies that a batch held."""

    def run(batches):
        out = _Rows(_PIECES)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            keys = [(i, hashlib.md5((t or "").encode()).digest()) for i, t in zip(ids, texts)]
            copies = Counter(keys)
            for (doc, thash), text in zip(keys, texts):
                if count := copies.pop((doc, thash), 0):
                    text = text or ""
                    form, a, b = planned(doc, text)
                    cuts = (None, None) if form == "plain" else (a, b - a)
                    yield from out.add((doc, thash, -1, len(text), form, *cuts, count, None))
                    for place, piece in enumerate(pieces_of(text, form, a, b, size)):
                        yield from out.add((doc, thash, place, None, None, None, None, None, piece), 2 * len(piece))
        yield from out.flush()

    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text_batches(known).mapInArrow(run, _PIECES)


def _assemble(batches):
    """Sorted pieces to parts: digests of the outputs as they stream by, and their text keyed by its place in the original."""
    out = _Rows(_PARTS)
    key, facts, digest, reader, place, seen = None, None, None, None, 0, -1

    def parts(found):
        nonlocal place
        for part, text in found:
            place += 1
            yield from out.add((*key, part, place, None, None, None, None, None, None, text), 2 * len(text))

    def close():
        yield from parts(reader.feed("", last=True))
        yield from out.add((*key, -1, 0, *facts, digest.hexdigest(), None))

    for batch in batches:
        for doc, thash, at, *given, copies, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (doc, thash):
                if key:
                    yield from close()
                key, facts, digest, reader, place, seen = (doc, thash), [*given, 0], hashlib.sha256(), Reader(given[1]), 0, -1
            if at < 0:
                facts[-1] += copies
            elif at > seen:  # another batch's copy of the piece goes by
                seen = at
                digest.update(piece.encode())
                yield from parts(reader.feed(piece))
    if key:
        yield from close()
    yield from out.flush()


def _restore(batches):
    """Parts in the order of the original to one row of results for each copy of a document."""
    out = _Rows(_RESULT)
    facts, digest = None, None

    def close():
        *given, copies, output = facts
        for _ in range(copies):
            yield from out.add((*given, output, digest.hexdigest()))

    for batch in batches:
        for doc, _, part, _, n, form, a, b, copies, output, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if part < 0:
                if facts:
                    yield from close()
                facts, digest = (doc, n, form, a, b, copies, output), hashlib.sha256()
            else:
                digest.update(piece.encode())
    if facts:
        yield from close()
    yield from out.flush()


def assembled(documents: DataFrame, planned: Callable = plan, size: int = PIECE) -> DataFrame:
    """The pieces of all outputs, each document's in one partition and in turn (doc_id, thash, place, piece and the facts)."""
    return emit_pieces(documents, planned, size).repartition("doc_id", "thash").sortWithinPartitions("doc_id", "thash", "place")


def fill_in_middle(documents: DataFrame, planned: Callable = plan, size: int = PIECE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the digests of output and restored text of every row."""
    parts = assembled(documents, planned, size).mapInArrow(_assemble, _PARTS)
    return parts.sortWithinPartitions("doc_id", "thash", "part", "place").mapInArrow(_restore, _RESULT)


def op12_secondary_sort_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents"))


OP12_SQL = """
with hashed as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), cut as (
  select *, ('0x' || h[1:8])::bigint % (n + 1) as x, ('0x' || h[9:16])::bigint % (n + 1) as y,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
         when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form
  from hashed
), parts as (
  select *, substr(text, 1, least(x, y)) as pre, substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) as mid, substr(text, greatest(x, y) + 1) as suf
  from cut
), outputs as (
  select *, case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end as output
  from parts
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then least(x, y)::bigint end as prefix_chars,
  case when form <> 'plain' then (greatest(x, y) - least(x, y))::bigint end as middle_chars, sha256(output) as output_sha256,
  sha256(case form when 'plain' then output
    when 'psm' then split_part(output[4:], '<S>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
    else split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(output[4:], '<P>', 1) end) as restored_sha256
from outputs
"""
