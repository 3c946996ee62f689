"""Token counts (operator 3): greedy longest-match word pieces, counted without building them.

A trie over the vocabulary has two roots: pieces that start a word hang from
one, pieces that continue a word from the other. Each node carries a failure
link and the number of pieces that are popped when the link is followed. A word
is read once, byte by byte; where the trie has no edge the count of popped
pieces is added and the link followed. That is linear in the word's length and
never backs up, unlike trying ever shorter prefixes.

The vocabulary comes from a byte-level BPE file: tokens that begin with the
space symbol start words, the others continue them. Words are runs of
characters other than space and \\t \\n \\v \\f \\r. A word that the pieces can't
spell counts as one unknown piece. Null and empty texts count nothing. Rows keep
their multiplicity, also with equal or null keys; texts are read whole; there are no ties.
Other columns of the input are not used, and an empty table gives an empty result.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame

from convaudit.llm.bpe import byte_symbols
from convaudit.llm.common import Memo, map_slices, texts_of

UNKNOWN = 1 << 40
START, CONTINUE = 0, 1


def pieces_of(text: str) -> tuple[list[bytes], list[bytes]]:
    """Word-start and continuing pieces of a byte-level BPE file, as bytes."""
    value = {s: b for b, s in enumerate(byte_symbols())}
    special = {t["content"] for t in json.loads(text)["added_tokens"]}
    raw = [bytes(value[c] for c in t) for t in json.loads(text)["model"]["vocab"] if t not in special]
    return [t[1:] for t in raw if t[:1] == b" " and len(t) > 1], [t for t in raw if t[:1] != b" "]


class PieceCounter:
    def __init__(self, starts: list[bytes], continues: list[bytes]):
        self.edge: dict[int, int] = {}
        ends: set[int] = set()
        nodes, levels = 2, [[], []]
        for root, pieces in ((START, starts), (CONTINUE, continues)):
            for piece in pieces:
                u = root
                for depth, b in enumerate(piece):
                    v = self.edge.get(u << 8 | b)
                    if v is None:
                        v = self.edge[u << 8 | b] = nodes
                        nodes += 1
                        if len(levels) <= depth:
                            levels.append([])
                        levels[depth].append((u, b, v))
                    u = v
                ends.add(u)
        self.link: list[int | None] = [None] * nodes
        self.popped = [0] * nodes
        for level in levels:  # shallow nodes first: their links are needed below
            for u, b, v in level:
                if v in ends:
                    self.link[v], self.popped[v] = CONTINUE, 1
                    continue
                z, count = self.link[u], self.popped[u]
                while z is not None and z << 8 | b not in self.edge:
                    count += self.popped[z]
                    z = self.link[z]
                if z is not None:
                    self.link[v], self.popped[v] = self.edge[z << 8 | b], count
        self.memo = Memo(self.count)

    def count(self, word: str) -> int:
        """Pieces of a word, or 1 + UNKNOWN."""
        edge, link, popped = self.edge, self.link, self.popped
        u, total = START, 0
        for b in word.encode():
            v = edge.get(u << 8 | b)
            while v is None:
                total += popped[u]
                u = link[u]
                if u is None:
                    return 1 + UNKNOWN
                v = edge.get(u << 8 | b)
            u = v
        while u != CONTINUE:
            total += popped[u]
            u = link[u]
            if u is None:
                return 1 + UNKNOWN
        return total


_BUILT: dict[int, PieceCounter] = {}


def built(text: str) -> PieceCounter:
    key = hash(text)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = PieceCounter(*pieces_of(text))
    return _BUILT[key]


def words_of(text: str) -> list[str]:
    """Runs of characters other than space and \\t \\n \\v \\f \\r."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    return [w.decode() for w in text.encode().split()]  # bytes split on just those six


def token_counts(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words``, ``n_tokens`` and ``n_unknown`` (longs) of every row."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    rows = df.select(key, text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo = built(spec.value).memo
        words, tokens, unknown = [], [], []
        for t in texts_of(batch):
            own = words_of(t)
            total = sum(map(memo.__getitem__, own))
            words.append(len(own))
            tokens.append(total % UNKNOWN)
            unknown.append(total // UNKNOWN)
        longs = [pa.array(x, pa.int64()) for x in (words, tokens, unknown)]
        return pa.RecordBatch.from_arrays([batch.column(0), *longs], [key, "n_words", "n_tokens", "n_unknown"])

    kind = rows.schema[key].dataType.simpleString()
    return map_slices(rows, run, f"`{key}` {kind}, n_words long, n_tokens long, n_unknown long")
