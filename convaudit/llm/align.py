"""Cross-tokenizer alignment (operator 13): exact texts once, weighted by their copies.

Rows are shuffled by their full text, so each distinct text is tokenised and
aligned once, however often it stands in the table. A text is cut into groups
where tokens of both vocabularies end on the same byte; two tokens are linked where their byte
ranges overlap. The count of an id pair is the number of rows whose text links
it: the copies of each distinct text that has it, summed. The measures of a text
then go back to all rows that have it, by the text's SHA-256.

A is a byte-level vocabulary (``tokenizers`` JSON) applied to a space and the
text, B a SentencePiece model that adds the space itself. Strings of special tokens in
a text are plain text.

For scale: a text travels once. A distinct text's links are stored as (A id, B id,
times) and counted by a map-side aggregate. The counts are one row per id
pair that occurs; while they fit in ``broadcast_bytes`` (measured) each task
looks its links up in a sorted copy, beyond that the links are joined to the stored counts,
where adaptive execution splits the frequent pairs.

Null and empty texts, and texts whose tokens' bytes don't join up to the space and the text
(B normalises them, or they hold U+2581) have no tokens: all measures are 0 and
``groups`` is empty. Repeated rows each count and keep their place. Long texts are
aligned whole, up to what one Arrow string can hold (2 GB of ``groups``, about 400 MB
of text). Ties for an A id's highest count all count as best. Other columns of the input aren't read; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convaudit.llm.bpe import byte_symbols
from convaudit.llm.common import drop_stored, map_slices, stored
from convaudit.llm.packing import LONG_SPACE, Encoder
from convaudit.operators.util import BROADCAST_BYTES

MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
LINK = "struct<a:int,b:int,times:int>"
#: Bytes of texts aligned at a time; the groups' text takes about five times as many.
TEXT_BYTES = 4 << 20


class Aligner:
    """Both vocabularies with their tokens' bytes."""

    def __init__(self, a_spec: str, b_model: bytes):
        self.a = Encoder(a_spec)
        self.a.library.encode_special_tokens = True
        value = {s: b for b, s in enumerate(byte_symbols())}
        vocab = self.a.library.get_vocab(with_added_tokens=True)
        special = set(self.a.special)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = token.encode() if token in special else bytes(value[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_bytes, self.b_bytes = (np.array([*x, None], dtype=object)[:-1] for x in (a_bytes, b_bytes))
        self.a_size, self.b_size = (np.array([len(t) for t in x], dtype=np.int64) for x in (a_bytes, b_bytes))
        # an id and what follows it: more of its side, or that side's end
        written = [f"{i}{end}" for size, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for end in ends for i in range(size)]
        self.written = np.array(written, dtype=object)

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both vocabularies, none where either's bytes aren't the text's."""
        if not text:
            return None
        spaced = " " + text
        if self.a.fast is None or len(text) >= 20_000 and LONG_SPACE.search(spaced):
            a = np.array(self.a.library.encode(spaced, add_special_tokens=False).ids, dtype=np.int64)
        else:
            a = self.a.fast.encode_to_numpy(spaced).astype(np.int64)
        b = np.array(self.b.encode(text), dtype=np.int64)
        raw = spaced.encode()
        whole = b"".join(self.a_bytes[a].tolist()) == raw and b"".join(self.b_bytes[b].tolist()) == raw
        return (a, b) if whole else None

    def align(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray, str]:
        """The four measures, the distinct links (A id times 2^32 plus B id) and how often each occurs, the groups."""
        ids = self.ids(text)
        if ids is None:
            return [0, 0, 0, 0], np.empty(0, np.int64), np.empty(0, np.int64), ""
        a, b = ids
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        mark = np.zeros(int(a_end[-1]) + 1, np.uint8)
        mark[a_end] = 1
        mark[b_end] += 2
        # a stretch between neighbouring ends lies in one token of each side: one link
        ends = mark[np.flatnonzero(mark)]
        of_a, of_b, both = ends & 1 == 1, ends >= 2, ends == 3
        links, times = np.unique(a[np.cumsum(of_a) - of_a] << 32 | b[np.cumsum(of_b) - of_b], return_counts=True)
        group = np.cumsum(both) - both
        n = int(both.sum())
        a_group, b_group = group[of_a], group[of_b]
        a_before, b_before = np.cumsum(np.bincount(a_group, minlength=n)), np.cumsum(np.bincount(b_group, minlength=n))
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.concatenate(([0], b_before))[a_group]] = a + both[of_a] * len(self.a_size)
        out[np.arange(len(b)) + a_before[b_group]] = 2 * len(self.a_size) + b + both[of_b] * len(self.b_size)
        return [len(a), len(b), n, len(ends)], links, times, "".join(self.written[out].tolist())[:-1]


_BUILT: dict[int, Aligner] = {}


def built(a_spec: str, b_model: bytes) -> Aligner:
    key = hash((a_spec, b_model))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Aligner(a_spec, b_model)
    return _BUILT[key]


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def align_texts(docs: DataFrame, a_vocabulary: str, b_model: str, text: str = "text") -> DataFrame:
    """Each distinct text that isn't empty, once: ``digest``, ``copies`` (rows), the measures, ``links``, ``groups``."""
    context = docs.sparkSession.sparkContext
    with open(a_vocabulary, encoding="utf-8") as f, open(b_model, "rb") as g:
        spec, model = context.broadcast(f.read()), context.broadcast(g.read())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        aligner = built(spec.value, model.value)
        rows = [aligner.align(t) for t in batch.column(0).to_pylist()]
        n = np.array([r[0] for r in rows], np.int64).reshape(-1, len(MEASURES))
        links, times = (np.concatenate([np.empty(0, np.int64), *[r[k] for r in rows]]) for k in (1, 2))
        at = np.concatenate(([0], np.cumsum([len(r[1]) for r in rows]))).astype(np.int32)
        flat = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (links >> 32, links & 0xFFFFFFFF, times)], ["a", "b", "times"])
        return pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), *[pa.array(x) for x in n.T], pa.ListArray.from_arrays(pa.array(at), flat),
             pa.array([r[3] for r in rows], pa.string())], ["digest", "copies", *MEASURES, "links", "groups"])

    texts = docs.select(F.col(text).alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    measures = ", ".join(f"{m} long" for m in MEASURES)
    return map_slices(texts.select("text", text_digest(F.col("text")).alias("digest"), "copies"), run,
                      f"digest binary, copies long, {measures}, links array<{LINK}>, groups string", size=TEXT_BYTES)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``n``: the rows whose text links the pair."""
    return aligned.select("copies", F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.sum("copies").alias("n"))


def _looked_up(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``digest``, ``n_best`` and ``count_sum`` by a sorted copy of ``counts`` in every task."""
    table = counts.toArrow()  # within the measured bound
    pair = table["a"].to_numpy().astype(np.int64) << 32 | table["b"].to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order], table["n"].to_numpy()[order]
    first = np.flatnonzero(np.diff(pair >> 32, prepend=-1))  # the first pair of each A id
    best = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(n)))) == n if len(n) else np.empty(0, bool)
    known = aligned.sparkSession.sparkContext.broadcast((pair, n, best))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pair, n, best = known.value
        links = batch.column(1)
        flat = links.flatten()
        key = flat.field("a").to_numpy().astype(np.int64) << 32 | flat.field("b").to_numpy()
        times, at = flat.field("times").to_numpy().astype(np.int64), np.searchsorted(pair, key)
        end = np.cumsum(links.value_lengths().to_numpy())
        sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[end], prepend=0) for x in (times * best[at], times * n[at])]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x.astype(np.int64)) for x in sums]], ["digest", "n_best", "count_sum"])

    return map_slices(aligned.select("digest", "links"), run, "digest binary, n_best long, count_sum long")


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by joins, for counts of any size."""
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    known = stored(counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    links = aligned.select("digest", F.explode("links").alias("l")).select("digest", "l.*")
    return links.join(known, ["a", "b"]).groupBy("digest").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def cross_align(docs: DataFrame, a_vocabulary: str, b_model: str, key: str = "doc_id", text: str = "text",
                groups: Callable[[Column], Column] = lambda g: g, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3``, ids in order; give a function
    of it (such as a digest) to store and send that instead.
    """
    aligned = align_texts(docs, a_vocabulary, b_model, text)
    aligned = stored(aligned.withColumn("groups", F.when(F.col("n_groups") > 0, groups(F.col("groups"))).otherwise("")), "aligned")
    counts = stored(pair_counts(aligned), "pair-counts")
    by = _looked_up if counts.count() * 16 <= broadcast_bytes else _joined
    scores = by(aligned.where("n_links > 0"), counts)
    measures = stored(aligned.drop("links", "copies").join(scores, "digest", "left"), "measures")
    drop_stored(aligned)
    drop_stored(counts)
    rows = docs.select(F.col(key).alias("key"), text_digest(F.col(text)).alias("digest")).join(measures, "digest", "left")
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in [*MEASURES, "n_best", "count_sum"]]
    return rows.select(F.col("key").alias(key), *sums, F.coalesce("groups", F.lit("")).alias("groups"))
