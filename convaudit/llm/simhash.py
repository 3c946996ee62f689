"""SimHash near-dedup (operator 4): deletion-variant signatures.

A fingerprint has 64 bits. Links are pairs that differ in at most ``bits`` of
them. Cut into (bits + 1) // 2 segments (two for three bits), so at least one
segment differs in at most one bit. Each value of a segment is indexed under
its one-wildcard variants (one bit blanked); an equality join over the variants
finds the values that differ in just that bit. Fingerprints whose segments are
equal or such neighbours meet in a bucket, and there they are verified.

Copies are one fingerprint from the start. A bucket isn't turned into pairs: a
task walks it breadth first, compares a fingerprint with those not yet reached
and gives a spanning forest of the links, so a dense group of near copies costs
about its size. A bucket of more than ``block`` members is cut into blocks, and
each two blocks are walked together by a task of their own, so every pair in it
is still compared. The forests go to ``components``.

Null and empty texts have the fingerprint zero and are linked like any other.
Repeated rows stay repeated. Columns other than key and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convaudit.llm.common import drop_stored, map_slices, stored, texts_of
from convaudit.llm.components import components


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles; signed."""
    own = text.encode().lower().split()  # bytes: A-Z and the six white space characters only
    if not own:
        return 0
    joined = b" ".join(own)
    digest = xxhash.xxh64_intdigest
    if len(own) < words:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, seed: int = 42) -> DataFrame:
    """``key`` and ``fp`` (long) of every row."""
    rows = df.select(key, text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, words, seed) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], [key, "fp"])

    return map_slices(rows, run, f"`{key}` {rows.schema[key].dataType.simpleString()}, fp long")


#: Segment values whose variants one task makes.
VALUES_PER_TASK = 50_000


def segment(fp: Column, number: int, of: int) -> Column:
    width = 64 // of
    return F.shiftrightunsigned(fp, number * width).bitwiseAND(F.lit((1 << width) - 1))


def buckets(distinct: DataFrame, bits: int) -> DataFrame:
    """``bucket`` (struct), ``fp``: fingerprints that share a segment's value, or whose values differ in one bit."""
    of = (bits + 1) // 2 or 1
    width = 64 // of
    values = distinct.select("fp", F.posexplode(F.array(*[segment(F.col("fp"), i, of) for i in range(of)])).alias("seg", "value"))
    sizes = stored(values.groupBy("seg", "value").agg(F.count(F.lit(1)).alias("n")), "segments")
    # the stored table is a few small files, each row of which makes ``width`` variants: as many tasks as they need
    sizes = sizes.repartition(sizes.count() // VALUES_PER_TASK + 1, "seg", "value")
    same = sizes.where("n > 1").select("seg", "value", F.col("value").alias("low"), F.lit(-1).alias("wild"), "n")
    # two values share a variant only if they differ in the blanked bit and nowhere else
    bit = F.expr("shiftleft(1L, wild)")
    variants = (sizes.select("seg", "value", "n", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("wild"))
                .select("seg", "wild", F.col("value").bitwiseAND(F.bitwise_not(bit)).alias("low"), "n"))
    pairs = variants.groupBy("seg", "wild", "low").agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n")).where("values > 1")
    both = pairs.select("seg", F.explode(F.array(F.col("low"), F.col("low").bitwiseOR(bit))).alias("value"), "low", "wild", "n")
    index = stored(same.unionByName(both), "buckets")
    return values.join(index, ["seg", "value"]).select("seg", "wild", "low", "n", "fp")


def forest(fps: np.ndarray, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links of a spanning forest of the graph of pairs at ``bits`` or fewer differing bits."""
    left, right, rest = [], [], fps
    while len(rest) > 1:
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            for x in queue.pop():
                near = np.bitwise_count(rest ^ x) <= bits
                if near.any():
                    reached, rest = rest[near], rest[~near]
                    left.append(np.full(len(reached), x))
                    right.append(reached)
                    queue.append(reached)
                    if not len(rest):
                        break
    return left, right


def links(distinct: DataFrame, bits: int = 3, block: int = 4096) -> DataFrame:
    """``a``, ``b``: enough links between fingerprints (column ``fp``) to connect all that are linked."""
    members = buckets(distinct, bits)
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks.cast("long")).cast("int")
    cells = members.select("seg", "wild", "low", "fp", own.alias("own"), blocks.alias("blocks"))
    # the block pairs (x, y), x <= y, that a member's own block is part of
    cells = cells.select("seg", "wild", "low", "fp", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(o, F.col("own")) * 65536 + F.greatest(o, F.col("own")))).alias("cell"))

    def walk(key: tuple, group: pa.Table) -> pa.Table:
        left, right = forest(group.column("fp").to_numpy().view(np.uint64), bits)
        flat = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (left, right)]
        return pa.table({"a": flat[0], "b": flat[1]})

    return cells.groupBy("seg", "wild", "low", "cell").applyInArrow(walk, "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key reachable over links) of every row."""
    prints = stored(fingerprints(df, key, text, words, seed), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    # components by fingerprint, then by the smallest key within them
    found = components(links(distinct.select("fp"), bits))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"), "first")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(least, "root").select("fp", "component_id"), "named-fingerprints")
    drop_stored(distinct)
    return prints.join(named, "fp").select(key, "fp", "component_id")
