"""BPE encoding and decoding (operator 1).

Every pre-token is merged with a segment tree over the ranks of its adjacent
pairs. A leaf holds ``rank * n + position`` of the pair that starts there, an
inner node the smaller of its children, so the root names the lowest rank and,
within it, the leftmost pair. A merge changes at most three leaves, each
repaired along one path to the root: O(n log n) for a pre-token of n symbols,
however long it is.

The vocabulary is a ``tokenizers`` JSON file of the word-end kind: NFC, white
space collapsed, lower case, a splitting pattern, byte-level symbols, a suffix
on the last symbol. Its text travels to the tasks as a broadcast of fixed size.

Null and empty texts give no ids and an empty decoded text. Special tokens
written out in a text become their ids, as the library reads them. Rows keep
their multiplicity; other columns of the input are not used.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from convaudit.llm.common import Memo, map_slices, texts_of

NO_PAIR = 1 << 62

#: Characters that Python's split() takes as white space and the vocabulary's pattern does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        out[b] = chr(b if b in plain else spare)
        spare += b not in plain
    return out


class Bpe:
    """One vocabulary; ``encode`` gives ids as little-endian unsigned 32-bit integers."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.first = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        self.rank, self.made = {}, []
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.rank.setdefault(vocab[a] << 32 | vocab[b], len(self.made))
            self.made.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = dict(sorted([(i, t) for t, i in vocab.items()] + [(i, t) for t, i in self.special.items()]))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = Memo(self._word)
        self.chunks = Memo(self._chunk)

    def merge(self, ids: list[int]) -> list[int]:
        """Merge a pre-token's symbols until no adjacent pair has a rank."""
        n, rank = len(ids), self.rank
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [NO_PAIR] * (2 * size)
        for i in range(n - 1):
            r = rank.get(ids[i] << 32 | ids[i + 1])
            if r is not None:
                tree[size + i] = r * n + i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        ahead, back = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                other = tree[k ^ 1]
                if other < value:
                    value = other
                k >>= 1
                if tree[k] == value:
                    return
                tree[k] = value

        def pair(i: int) -> None:
            j = ahead[i]
            r = rank.get(ids[i] << 32 | ids[j]) if j < n else None
            put(i, NO_PAIR if r is None else r * n + i)

        while tree[1] != NO_PAIR:
            r, i = divmod(tree[1], n)
            j = ahead[i]
            ids[i], ids[j] = self.made[r], -1
            ahead[i] = ahead[j]
            if ahead[j] < n:
                back[ahead[j]] = i
            if j < n - 1:
                put(j, NO_PAIR)
            if i < n - 1:
                pair(i)
            if back[i] >= 0:
                pair(back[i])
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        ids = [self.first[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return np.array(self.merge(ids), "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """``chunk`` holds no white space of the pattern."""
        low = "".join([c.lower() for c in unicodedata.normalize("NFC", chunk)])
        return b"".join([self.words[w] for w in self.split.findall(low)])

    def _plain(self, text: str) -> bytes:
        if any(c in text for c in NOT_SPACE):
            return b"".join([self.chunks[c] for c in regex.split(r"\s+", text) if c])
        return b"".join([self.chunks[c] for c in text.split()])

    def encode(self, text: str) -> bytes:
        if self.cut and any(s in text for s in self.special):
            return b"".join([np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._plain(p)
                             for p in self.cut.split(text)])
        return self._plain(text)

    def decode(self, ids: bytes) -> str:
        """The tokens joined by spaces: what the library gives for a vocabulary without a decoder."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


_BUILT: dict[int, Bpe] = {}


def built(text: str) -> Bpe:
    """The vocabulary of ``text``, built once in each Python worker."""
    key = hash(text)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Bpe(text)
    return _BUILT[key]


def encode_decode(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of every row.

    ``vocabulary`` is the path of the JSON file on the driver.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(key, text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = built(spec.value)
        ids = [bpe.encode(t) for t in texts_of(batch)]
        decoded = [bpe.decode(i) for i in ids]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                                          [key, "ids", "decoded"])

    return map_slices(rows, run, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids binary, decoded string")
