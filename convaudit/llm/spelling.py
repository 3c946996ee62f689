"""Spelling variant grouping (operator 12): PartEnum signatures over letter multisets.

A word is the binary vector of its (letter, occurrence) pairs. Words one edit
apart differ in two of them at most: in two after a replaced letter, in one
after an inserted or deleted one. The dimensions are dealt to parts; vectors that differ
in d of them agree on some choice of all but d parts, so the contents of
every such choice are the signatures (``SAME``: 5 parts, choose 3; ``LONGER``: 4
parts, choose 3). An edit also leaves one half of a word as it is, so a
signature names the words' length and one half too: words that merely share
letters don't meet, and no group has more than the words of one half and almost
one multiset. Equal signatures are joined, the edit is verified in the join, and a
pair found under several signatures counts once.

Then each word's form is its most frequent near word, if that is at least ``factor``
times as frequent; the root is the end of the chain of forms. A chain at least doubles the
count at every step, so following it takes a handful of joins, each pointer jump stored.

For scale: a task counts the words of its texts in a bounded table before anything is
shuffled; all later steps work on the vocabulary. Nothing is collected but the frequency of
each letter (192 letters at most), which balances the parts.

Null and empty texts have no words; a null id is written as nothing before the colon. Repeated rows count
each. Runs of any length are words like others (one is sent once per signature, about 36 times). Ties for the
largest near word go to the smallest in code-point order. Other columns aren't read; an empty table has
no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convaudit.llm.common import drop_stored, map_slices, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A task's table of counts is passed on when it has this many words.
COUNTED = 300_000
#: Texts longer than this are read run by run instead of all runs at once.
LONG_TEXT = 1 << 20

# (parts, chosen): any vectors that differ in (parts - chosen) dimensions agree on one choice
SAME, LONGER = (5, 3), (4, 3)
REPLACED, SHORTER_SIDE, LONGER_SIDE = 0, 1, 2


def words_of(doc_id, text: str, drop: int) -> Iterator[tuple[str, int]]:
    """Lower-cased runs and how often they occur; where ``drop`` divides a run's hash, without one of its letters."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    runs = RUN.findall(text) if len(text) < LONG_TEXT else (m[0] for m in RUN.finditer(text))
    for run, n in Counter(runs).items():
        word = run.translate(LOWER)
        h = zlib.crc32(word.encode(), start)
        if h % drop == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, n


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3,
               drop: int = 97) -> DataFrame:
    """``word`` and ``n`` of the words long and frequent enough."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in words_of(doc_id, body.as_py() or "", drop):
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    counted = docs.select(key, text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


class Signer:
    """Signatures of words; letters are dealt to parts in order of frequency, so that parts weigh alike."""

    def __init__(self, letters: list[str]):
        self.rank = {c: i for i, c in enumerate(letters)}

    def choices(self, word: str, kind: tuple[int, int]) -> list[bytes]:
        """What the word's vector holds in every choice of parts."""
        parts, chosen = kind
        held, seen = [[] for _ in range(parts)], Counter()
        for c in sorted(word):
            held[(self.rank[c] + seen[c]) % parts].append(c)  # the dimension (c, occurrence)
            seen[c] += 1
        held = ["".join(h) for h in held]
        return ["\x00".join([str(i), *pick]).encode() for i, pick in enumerate(combinations(held, chosen))]

    def signatures(self, word: str) -> list[tuple[int, int]]:
        """(key, role) pairs. Near words of one length share a key in role ``REPLACED``; where one is longer, its
        role is ``LONGER_SIDE`` and the other's ``SHORTER_SIDE``."""
        n, out = len(word), []
        same, longer = self.choices(word, SAME), self.choices(word, LONGER)
        # (role, shorter length, choices, first half, second half): the edit lies in one half, the other is equal
        a, b = n // 2, (n - 1) // 2
        for role, length, chosen, halves in ((REPLACED, n, same, (word[:a], word[a:])), (SHORTER_SIDE, n, longer, (word[:a], word[a:])),
                                             (LONGER_SIDE, n - 1, longer, (word[:b], word[b + 1:]))):
            for side, half in enumerate(halves):
                head = f"{role > 0:d}:{length}:{side}:{half}\x00".encode()
                out += [(xxhash.xxh64_intdigest(head + c) - (1 << 63), role) for c in chosen]
        return out


def letters_by_frequency(words: DataFrame) -> list[str]:
    """At most the 192 letters that a run can hold, the most frequent first."""
    counts = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect()
    return [r.c for r in sorted(counts, key=lambda r: (-r["count"], r.c))]


def signatures(words: DataFrame) -> DataFrame:
    """``key``, ``role``, ``word``, ``n``: all signatures of every word."""
    signer = Signer(letters_by_frequency(words))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = [signer.signatures(w) for w in batch.column(0).to_pylist()]
        of = pa.array([i for i, s in enumerate(every) for _ in s], pa.int64())
        keys, roles = (pa.array([x[k] for s in every for x in s], t) for k, t in ((0, pa.int64()), (1, pa.int32())))
        return pa.RecordBatch.from_arrays([keys, roles, batch.column(0).take(of), batch.column(1).take(of)], ["key", "role", "word", "n"])

    return map_slices(words.select("word", "n"), run, "key long, role int, word string, n long", rows=4096)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``a_n``, ``b``, ``b_n``: each pair of words one edit apart, once."""
    signed = stored(signatures(words), "signatures")
    left = signed.where(F.col("role") != LONGER_SIDE).select("key", "role", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = signed.where(F.col("role") != SHORTER_SIDE).select("key", F.col("role").alias("b_role"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    meet = ((F.col("role") == REPLACED) & (F.col("b_role") == REPLACED) & (F.col("a") < F.col("b"))
            | (F.col("role") == SHORTER_SIDE) & (F.col("b_role") == LONGER_SIDE))
    near = F.levenshtein("a", "b", 1) == 1
    found = left.join(right, (left["key"] == right["key"]) & meet & near)
    pairs = stored(found.select("a", "a_n", "b", "b_n").distinct(), "near-words")
    drop_stored(signed)
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every word that has a form, by pointer jumping."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        after = stored(now.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        drop_stored(now)
        if not after.agg(F.bool_or("moved")).first()[0]:
            return after.drop("moved")
        now = after.drop("moved")


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3,
                    factor: int = 2, drop: int = 97) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every word."""
    words = stored(vocabulary(docs, key, text, least_length, least_count, drop), "words")
    pairs = near_pairs(words)
    both = pairs.union(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("neg"), F.col("b").alias("word")))
    near = both.groupBy(F.col("a").alias("near_to")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.neg") >= factor * F.col("n")
    out = stored(words.join(near, F.col("word") == F.col("near_to"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.word")).alias("form"),
        F.when(strong, -F.col("best.neg")).alias("form_n")), "forms")
    drop_stored(pairs)
    drop_stored(words)
    ends = roots(out.where("form is not null")).select(F.col("word").alias("of"), "root")
    return out.join(ends, F.col("word") == F.col("of"), "left").drop("of").withColumn("root", F.coalesce("root", "word"))
