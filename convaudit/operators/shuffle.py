"""Seeded global shuffle (W3): every row's place in a pseudo-random order, without one task that sorts all.

A row's order is the SHA-256 of the seed and its key. The digests' first bits deal rows over
buckets that are also ranges of the order; a bucket's offset is the number of rows in those
before it, and within a bucket rows are numbered on their own. One exchange of the rows, an
aggregate of one row per bucket, and the same places whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = 42, digits: int = 3, out: str = "place") -> DataFrame:
    """``df`` with each row's place, from 0 without gaps.

    ``keys`` name a row (null is written as nothing); rows equal in them are ordered by all their columns' hash.
    There are 16 to the power of ``digits`` buckets; with 10^11 rows take 5.
    """
    written = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    rows = df.withColumn("_digest", F.sha2(written, 256)).withColumn("_bucket", F.substring("_digest", 1, digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy("_digest", F.xxhash64(*df.columns))
    placed = rows.join(F.broadcast(offsets), "_bucket").withColumn(out, F.col("_offset") + F.row_number().over(within) - 1)
    return placed.select(*df.columns, F.col(out).cast("long").alias(out))
