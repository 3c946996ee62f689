"""Substring dedup (operator 9): line hashing.

A unit is a line (or a paragraph, with another separator), and within a line of
several sentences also each sentence, so that a passage quoted in the middle of a
line is found. A unit is normalised (lower case, runs of white space to one space,
trimmed) and hashed to 128 bits. Units of the same digest are grouped over the
whole corpus; the earliest one by (key, text hash, place in the text) stays and the
others go, also within one document, with their offsets in the original text
retained. Lines of fewer than ``least_words`` words and sentences of fewer than
``least_sentence`` are never removed (0: no sentence units).

A passage that starts or ends inside a sentence keeps what it has of that sentence.
With ``window`` over 0 the pieces of a line are units too, whose borders depend on
the words alone: a piece starts at a word that, hashed with the word before it, has
the smallest hash among the ``window`` words on either side. Pieces of ``window``
words or fewer are never removed, so of a repeated passage the words up to its first
border and from its last one on stay. Pieces match pieces only.

Grouping takes one row of fixed width per unit, aggregated before the shuffle,
so a line that a third of the documents share meets as a few counts. Only
digests seen twice or more are joined back, against a stored table, so that the
engine may split a frequent digest. Texts are cut in Arrow batches.

A line that loses all its sentences goes as a line does. Null texts stay null and
have no unit; so have empty texts. Rows equal in key and text are one document and
get the same result; rows of one key with different texts are told apart by the
text's hash. Other columns pass through; a clash with a column made here is an
error that names it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convaudit.llm.common import map_slices, stored

SPACES = " \t\n\x0b\x0c\r"
#: The end of a sentence and the white space after it.
SENTENCE_END = re.compile(r"[.!?][\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: In a place: the number is that of a piece, not of a sentence.
PIECE = 1 << 31
ADDED = ["n_units", "n_removed", "removed"]


def sentences(line: str) -> list[tuple[int, int]]:
    """Where the sentences of a line start and end, without the white space between them."""
    out, start = [], 0
    for m in SENTENCE_END.finditer(line):
        out.append((start, m.start() + 1))
        start = m.end()
    return [*out, (start, len(line))]


def words_of(unit: str) -> list[bytes]:
    return unit.lower().encode().split()  # bytes split on the six ASCII white space characters


def starts_of(words: list[bytes], window: int) -> list[int]:
    """The numbers of the words that begin a piece."""
    if len(words) < 2:
        return [0]
    h = np.array([xxhash.xxh3_64_intdigest(a + b" " + b) for a, b in zip(words, words[1:])], np.uint64)
    most = np.full(window, np.iinfo(np.uint64).max)
    near = np.lib.stride_tricks.sliding_window_view(np.concatenate((most, h, most)), window)
    before, after = near[:len(h)].min(axis=1), near[window + 1:].min(axis=1)
    return [0, *(np.flatnonzero((h < before) & (h <= after)) + 1).tolist()]


def pieces(line: str, window: int) -> list[tuple[int, int]]:
    """Where the pieces of a line start and end, without the white space between them."""
    at = [m.span() for m in WORD.finditer(line)]
    starts = starts_of(words_of(line), window)
    return [(at[a][0], at[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(at)])]


def units_of(text: str, separator: str, least_words: int, least_sentence: int, window: int = 0) -> Iterator[tuple[int, bytes]]:
    """(place, normalised unit) of all that may go. A place is the line's number times 2**32, plus 1 + a sentence's number or PIECE + a piece's."""
    for i, line in enumerate(text.split(separator)):
        words = words_of(line)
        if words and len(words) >= least_words:
            yield i << 32, b" ".join(words)
        if 0 < least_sentence < len(words):
            cuts = sentences(line)
            if len(cuts) > 1:
                for s, (a, b) in enumerate(cuts, 1):
                    own = words_of(line[a:b])
                    if len(own) >= least_sentence:
                        yield i << 32 | s, b" ".join(own)
        if window and words:
            starts = starts_of(words, window)
            for c, (a, b) in enumerate(zip(starts, [*starts[1:], len(words)])):
                if b - a > window:
                    yield i << 32 | PIECE | c, b" ".join(words[a:b])


def without_pieces(line: str, number: int, gone: set[int], window: int) -> tuple[str, list[tuple[int, int]]]:
    """The line without its sentences and pieces at the places ``gone``, and where those were; overlapping ones are one."""
    cuts = []
    for own, first in ((sentences(line), 1), (pieces(line, window), PIECE)):
        ends = [a for a, _ in own[1:]] + [len(line)]
        cuts += [(a, b, end) for c, ((a, b), end) in enumerate(zip(own, ends), first) if number << 32 | c in gone]
    left, spans, at = [], [], 0
    for a, b, end in sorted(cuts):
        if spans and a <= at:
            spans[-1] = (spans[-1][0], max(spans[-1][1], b))
        else:
            left.append(line[at:a])
            spans.append((a, b))
        at = max(at, end)
    rest = "".join(left) + line[at:]
    return rest.rstrip(SPACES) if at == len(line) else rest, spans


def without(text: str, separator: str, gone: set[int], window: int = 0) -> tuple[str, list[tuple[int, int]]]:
    """The text without the units at the places ``gone``, and where those were."""
    kept, spans, at, cut = [], [], 0, {g >> 32 for g in gone}
    for i, line in enumerate(text.split(separator)):
        if i << 32 in gone:
            spans.append((at, at + len(line)))
        elif i not in cut:
            kept.append(line)
        elif window:
            rest, own = without_pieces(line, i, gone, window)
            spans += [(at + a, at + b) for a, b in own]
            if rest.strip(SPACES):
                kept.append(rest)
        else:
            cuts, left = sentences(line), []
            for s, (a, b) in enumerate(cuts, 1):
                if i << 32 | s in gone:
                    spans.append((at + a, at + b))
                else:
                    left.append(line[a:cuts[s][0] if s < len(cuts) else b])
            rest = "".join(left)
            if i << 32 | len(cuts) in gone:
                rest = rest.rstrip(SPACES)
            if rest.strip(SPACES):
                kept.append(rest)
        at += len(line) + len(separator)
    return separator.join(kept), spans


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def digests(df: DataFrame, key: str, text: str, separator: str, least_words: int, least_sentence: int, window: int = 0) -> DataFrame:
    """One row per unit that may go: ``key``, the text's hash, the place, and a digest of two longs."""
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("of"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        source, place, h1, h2 = [], [], [], []
        digest = xxhash.xxh3_128_intdigest
        for row, t in enumerate(batch.column(2).to_pylist()):
            for at, body in units_of(t, separator, least_words, least_sentence, window):
                h = digest(body, 1 if at & PIECE else 0)
                source.append(row)
                place.append(at)
                h1.append(signed(h >> 64))
                h2.append(signed(h & (1 << 64) - 1))
        own = pa.array(source, pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), *(pa.array(x, pa.int64()) for x in (place, h1, h2))],
                                          ["key", "of", "place", "h1", "h2"])

    return map_slices(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, of long, place long, h1 long, h2 long")


def removals(df: DataFrame, key: str, text: str, separator: str, least_words: int, least_sentence: int, window: int = 0) -> DataFrame:
    """``key``, ``of`` and the places of the units that go, for documents that lose any."""
    units = digests(df, key, text, separator, least_words, least_sentence, window)
    own = F.struct("key", "of", "place")
    first = units.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("first"))
    shared = stored(first.where("n > 1").select("h1", "h2", "first"), "shared-units")
    gone = units.join(shared, ["h1", "h2"]).where(~own.eqNullSafe(F.col("first")))
    return gone.groupBy("key", "of").agg(F.collect_set("place").alias("gone"))


def dedup_units(df: DataFrame, key: str = "doc_id", text: str = "text", separator: str = "\n", least_words: int = 5,
                least_sentence: int = 8, window: int = 0) -> DataFrame:
    """``df`` with the kept text in ``text``, ``n_units`` (lines with a word), ``n_removed`` and ``removed`` (start, end in the original)."""
    clash = {*ADDED, "__of", "__key", "__gone"} & set(df.columns)
    if clash:
        raise ValueError(f"columns to rename first: {sorted(clash)}")
    gone = removals(df, key, text, separator, least_words, least_sentence, window).select(
        F.col("key").alias("__key"), F.col("of").alias("__of"), F.col("gone").alias("__gone"))
    rows = df.join(gone, F.col(key).eqNullSafe(F.col("__key")) & (F.xxhash64(text) == F.col("__of")), "left").drop("__key", "__of")
    at, last = df.columns.index(text), len(df.columns)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_units, removed = [], [], []
        for t, drop in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist()):
            n_units.append(sum(1 for x in (t or "").split(separator) if x.strip(SPACES)))
            kept, spans = without(t, separator, set(drop), window) if drop else (t, [])
            texts.append(kept)
            removed.append([{"start": a, "end": b} for a, b in spans])
        spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(last)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n_units, pa.int64()), pa.array([len(x) for x in removed], pa.int64()), spans],
                                          [*batch.schema.names[:last], *ADDED])

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*df.schema.fields, T.StructField("n_units", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", T.ArrayType(span))])
    return map_slices(rows, run, schema)
