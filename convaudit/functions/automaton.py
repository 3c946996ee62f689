"""Aho-Corasick automaton over a lexicon, in flat arrays, run over many texts at once.

Used for lexicons too large for a regular expression. Goto, failure and output
links are plain arrays: built level by level on the driver from a bounded list of
entries, broadcast, and read by vectorised steps in the tasks. Goto edges are an open-addressing
hash table of (state, character class); the root's and the first level's are a
dense table, where nearly every failure ends.

Texts are cut into pieces that overlap by one character less than the longest entry, so one
very long text costs what many short ones do, and all pieces of a block advance together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Characters of one piece, unless entries are longer; pieces that advance together.
PIECE, TOGETHER = 256, 4096
MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


class Automaton:
    """Entries as a trie with failure links; ``out`` marks states where an entry ends, at the state or at a suffix of it."""

    def __init__(self, entries: Iterable[str]):
        words = sorted({e for e in entries if e})
        self.size = max(map(len, words), default=0)
        codes = _codes(words)
        self.letters = np.unique(codes)  # class 0 stands for every other character
        self.width = len(self.letters) + 1
        lengths = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(lengths) - lengths
        classes = np.searchsorted(self.letters, codes) + 1
        # level by level: a state is a distinct (parent, class); states of one level follow each other
        at, keys, ends, levels, n = np.zeros(len(words), np.int64), [], [], [1], 1
        for depth in range(self.size):
            going = np.flatnonzero(lengths > depth)
            key, inverse = np.unique(at[going] * self.width + classes[first[going] + depth], return_inverse=True)
            at[going] = n + inverse
            keys.append(key)
            ends.append(at[going[lengths[going] == depth + 1]])
            n += len(key)
            levels.append(n)
        self.states = n
        key = np.concatenate([np.empty(0, np.int64), *keys])
        self._hash(key, np.arange(1, n))
        self.dense_states = levels[1] if len(levels) > 1 else 1
        self.dense = np.zeros((self.dense_states, self.width), np.int32)
        top = key // self.width == 0
        self.dense[:, key[top] % self.width] = np.arange(1, n)[top]  # what the root does, its children do but for their own edges
        below = (key // self.width > 0) & (key // self.width < self.dense_states)
        self.dense[key[below] // self.width, key[below] % self.width] = np.arange(1, n)[below]
        self.fail = np.zeros(n, np.int32)
        self.out = np.zeros(n, bool)
        for e in ends:
            self.out[e] = True
        for a, b in zip(levels[1:], levels[2:]):
            parent, letter = np.divmod(key[a - 1:b - 1], self.width)
            self.fail[a:b] = self.step(self.fail[parent], letter)
            self.out[a:b] |= self.out[self.fail[a:b]]

    def _hash(self, key: np.ndarray, to: np.ndarray) -> None:
        bits = max(4, int(2 * len(key) + 1).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        left, slot = np.arange(len(key)), self._slot(key)
        while len(left):
            free = left[self.key[slot[left]] < 0]
            self.key[slot[free]] = key[free]  # of several for one slot the last stays
            won = left[self.key[slot[left]] == key[left]]
            self.to[slot[won]] = to[won]
            left = left[self.key[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one more character each, along failure links where there is no edge."""
        out = np.zeros(len(state), np.int32)
        todo = np.flatnonzero(letter)  # a character of no entry leads to the root
        s, c = state[todo].astype(np.int64), letter[todo].astype(np.int64)
        while len(todo):
            near = s < self.dense_states
            if near.any():
                out[todo[near]] = self.dense[s[near], c[near]]
                far = ~near
                todo, s, c = todo[far], s[far], c[far]
                if not len(todo):
                    break
            key = s * self.width + c
            slot = self._slot(key)
            seen = self.key[slot]
            other = np.flatnonzero((seen != key) & (seen >= 0))
            while len(other):  # another key's slot: look on
                slot[other] = (slot[other] + 1) & self.mask
                seen[other] = self.key[slot[other]]
                other = other[(seen[other] != key[other]) & (seen[other] >= 0)]
            found = seen == key
            out[todo[found]] = self.to[slot[found]]
            lost = ~found
            todo, s, c = todo[lost], self.fail[s[lost]].astype(np.int64), c[lost]
        return out

    def contained(self, texts: Sequence[str]) -> np.ndarray:
        """Per text whether it holds an entry."""
        hit = np.zeros(len(texts), bool)
        lengths = np.array([len(t) for t in texts], np.int64)
        if not self.size or not lengths.sum():
            return hit
        codes = _codes(texts)
        place = np.searchsorted(self.letters, codes)
        place[place == len(self.letters)] = 0
        classes = np.where(self.letters[place] == codes, place + 1, 0).astype(np.int32)
        start = np.cumsum(lengths) - lengths
        piece = max(PIECE, 4 * self.size)
        stride = piece - self.size + 1
        pieces = np.where(lengths > 0, np.maximum(1, -(-(lengths - self.size + 1) // stride)), 0)
        of = np.repeat(np.arange(len(texts)), pieces)
        offset = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * stride
        size = np.minimum(lengths[of] - offset, piece)
        order = np.argsort(-size, kind="stable")
        for k in range(0, len(order), TOGETHER):
            block = order[k:k + TOGETHER]
            begin, n, mine = (start[of] + offset)[block], size[block], of[block]
            state, found = np.zeros(len(block), np.int32), np.zeros(len(block), bool)
            for t in range(int(n[0])):
                going = int(np.searchsorted(-n, -t))  # pieces longer than t: they come first
                state[:going] = self.step(state[:going], classes[begin[:going] + t])
                found[:going] |= self.out[state[:going]]
                if t % 16 == 15:
                    hit[mine[found]] = True
                    begin, n, mine, state = (x[~found] for x in (begin, n, mine, state))
                    found = np.zeros(len(n), bool)
                    if not len(n) or n[0] <= t + 1:
                        break
            hit[mine[found]] = True
        return hit


def shards(entries: Iterable[str], most: int) -> list[list[str]]:
    """Entries in groups of neighbouring first characters, of at most ``most`` characters each (or one entry)."""
    out, held = [[]], 0
    for e in sorted(set(entries)):
        if out[-1] and held + len(e) > most:
            out.append([])
            held = 0
        out[-1].append(e)
        held += len(e)
    return out


#: Longest prefix by which entries of a distributed lexicon are looked up.
PREFIX = 16
#: Bits of a prefix's key that a filter holds.
PROBES = 4
ODD = np.uint64(0x100000001B3)


def prefix_keys(entries: Sequence[str]) -> np.ndarray:
    """A 64-bit key of each entry's first ``PREFIX`` characters, or of all of a shorter one (empty: of none)."""
    lengths = np.array([len(e) for e in entries], np.int64)
    codes = _codes(entries).astype(np.uint64)
    first, out = np.cumsum(lengths) - lengths, np.zeros(len(entries), np.uint64)
    for k in range(PREFIX):
        going = np.flatnonzero(lengths > k)
        out[going] = out[going] * ODD + codes[first[going] + k] + np.uint64(1)
    return _mixed(out, np.minimum(lengths, PREFIX).astype(np.uint64))


def gram_keys(texts: Sequence[str], sizes: Iterable[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and ``prefix_keys`` key of every run of so many characters in the texts, size by size."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = _codes(texts).astype(np.uint64)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters to the text's end
    out = np.zeros(len(codes), np.uint64)
    for k in range(1, max(sizes, default=0) + 1):
        out[:len(out) - k + 1] = out[:len(out) - k + 1] * ODD + codes[k - 1:] + np.uint64(1)
        if k in sizes:
            whole = left >= k
            yield of[whole], _mixed(out[whole], np.uint64(k))


def _mixed(key: np.ndarray, size: np.ndarray | np.uint64) -> np.ndarray:
    key = (key + size) * MIX
    return (key ^ key >> np.uint64(31)) * MIX


#: Characters of the entries in one automaton: it takes about 60 bytes for each.
SHARD_CHARS = 1 << 20
#: Characters of texts looked at together.
TEXT_CHARS = 1 << 20


def chunks(values: Sequence[str]) -> list[tuple[int, int]]:
    """The texts' numbers in ranges of about ``TEXT_CHARS`` characters (or one text)."""
    cuts = np.flatnonzero(np.diff(np.cumsum([len(v) for v in values]) // TEXT_CHARS, prepend=-1)).tolist()
    return list(zip(cuts, [*cuts[1:], len(values)]))


def hits(spark: SparkSession, texts: Column, entries: Iterable[str]) -> Column:
    """Per element of the array ``texts`` whether it holds an entry (null: no); one array of booleans per row.

    A lexicon over ``SHARD_CHARS`` makes several automata, a text that one of them found isn't shown to the next.
    """
    entries = set(entries)
    if "" in entries:
        return F.transform(texts, lambda t: t.isNotNull())
    known = [spark.sparkContext.broadcast(Automaton(s)) for s in shards(entries, SHARD_CHARS)]

    def run(arrays: pa.Array) -> pa.Array:
        values = ["" if t is None else t for t in arrays.flatten().to_pylist()]
        hit = np.zeros(len(values), bool)
        for a, b in chunks(values):
            for automaton in known:
                left = a + np.flatnonzero(~hit[a:b])
                hit[left] = automaton.value.contained([values[i] for i in left])
        sizes = arrays.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(hit))

    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<boolean>")(texts)
