"""Connected components over links, as Spark joins.

Alternating star rounds: each node's larger neighbours, then its smaller ones,
are linked to the smallest node it sees, until nothing changes. The number of
links never grows, and every round ends in a stored table in the shared folder,
so a lost executor costs one round at most. Nothing is collected but a count and
a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convaudit.llm.common import drop_stored, stored


def _large_star(links: DataFrame) -> DataFrame:
    """``links``: (u, v), u > v. Larger neighbours of u move to the smallest of its neighbourhood."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    moved = links.select(F.col("v").alias("w"), "u").join(least, "w").select("u", F.col("m").alias("v"))
    return moved.where("u > v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of u, and u, move to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.explode(F.array(
        F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
    return moved.where("u > v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that isn't the smallest of its own.

    ``links`` has two long columns; order, repeats and self-links don't matter.
    """
    a, b = links.columns
    now = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        after = stored(_small_star(_large_star(now)), "links")
        seen, mark = mark, _mark(after)
        drop_stored(now)
        now = after
        if seen == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
