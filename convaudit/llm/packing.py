"""Packing (operator 10): power-of-two decomposition.

A document of n tokens is cut into as many pieces of the full width as fit,
then into one piece for each binary digit of the rest, longest first. Each piece
is a sequence of its own, so no sequence crosses documents and none is padded:
every length is a power of two. Sequences of one length make up one bucket; the
low bits of ``sequence_id`` name it, and a trainer draws its batches from a
bucket at a time.

A document's ids are those of the ``tokenizers`` library for its whole text, then an
end id. Where the vocabulary's ids are its merge ranks (checked when it is loaded)
``tiktoken`` gives the same ids from the same file several times faster and is used;
texts that hold a special token or endless white space, and vocabularies of another kind, go through
``tokenizers`` itself. Null and empty texts have just the end id.

``sequence_id`` is made of the task's partition, a running number and the
bucket: unique within a result, and equal again when a lost task is run anew
over the same rows. Repeated rows, also with equal or null keys, are packed each on its own; long
texts are encoded whole. Other columns of the input are not used, and an empty table gives no piece.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from convaudit.llm.bpe import byte_symbols
from convaudit.llm.common import slices, texts_of

#: The byte-level pre-tokenizer's splitting pattern (a fixed value of that vocabulary kind).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: White space of this length is left to the library: the other one's pattern matcher backtracks over it on the stack.
LONG_SPACE = re.compile(r"\s{20000}")


def ranks_of(spec: dict) -> dict[bytes, int] | None:
    """Token bytes by id, if the ids are 256 bytes followed by the merges in order under the plain byte-level rules."""
    model, plain = spec["model"], {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or spec["post_processor"] or any(pre.get(k) != v for k, v in plain.items()):
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    symbols = byte_symbols()
    value = {s: b for b, s in enumerate(symbols)}
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or {vocab.get(s) for s in symbols} != set(range(256)):
        return None
    return {bytes(value[c] for c in t): i for t, i in vocab.items()} if len(vocab) == 256 + len(merges) else None


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, text: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(text)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ranks = ranks_of(json.loads(text))
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranks else None

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special) or len(text) >= 20_000 and LONG_SPACE.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


_BUILT: dict[int, Encoder] = {}


def built(text: str) -> Encoder:
    key = hash(text)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Encoder(text)
    return _BUILT[key]


def lengths(n: int, width: int) -> list[int]:
    """Full pieces, then the binary digits of what is left, longest first."""
    rest = n % width
    return [width] * (n // width) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(df: DataFrame, vocabulary: str, width: int = 2048, end_id: int = 1, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    if width & (width - 1):
        raise ValueError("width must be a power of two")
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(key, text)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = built(spec.value), 0
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                source, start, length, ids, total, sequence = [], [], [], [], [], []
                for row, t in enumerate(texts_of(part)):
                    own, first = encoder.encode(t) + end, 0
                    for n in lengths(len(own) // 4, width):
                        source.append(row)
                        start.append(first)
                        length.append(n)
                        ids.append(own[4 * first:4 * (first + n)])
                        total.append(len(own) // 4)
                        sequence.append(base | number << 5 | n.bit_length() - 1)
                        first += n
                        number += 1
                longs = [pa.array(x, pa.int64()) for x in (start, length, total, sequence, [0] * len(start))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64())), longs[0], longs[1], pa.array(ids, pa.binary()), *longs[2:]],
                    [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long")
