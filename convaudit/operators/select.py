"""Pick the most telling sentence per record.

The aggregate form, ``max(struct(score, -pos, text))``, is the default: it is
partially aggregated on the map side, so a record with a million sentences
sends one row per task to the shuffle, and ties go to the earliest sentence.
(``max_by`` is not used: on a tie it may return any of the tied rows.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_struct(score: str = "score", pos: str = "pos", text: str = "text") -> Column:
    """Orderable (score, -pos, text): larger score wins, then the earlier position."""
    return F.struct(F.col(score).alias("score"), (-F.col(pos)).alias("neg_pos"), F.col(text).alias("text"))


def _unpack(best: str, prefix: str = "best") -> list[Column]:
    return [F.col(f"{best}.score").alias(f"{prefix}_score"),
            (-F.col(f"{best}.neg_pos")).alias(f"{prefix}_pos"),
            F.col(f"{best}.text").alias(f"{prefix}_text")]


def argmax(df: DataFrame, keys: Sequence[str], score: str = "score", pos: str = "pos",
           text: str = "text") -> DataFrame:
    """Per group of ``keys``: the highest-scoring row, earliest on ties (A1, A3)."""
    agg = df.groupBy(*keys).agg(F.max(best_struct(score, pos, text)).alias("_best"))
    return agg.select(*keys, *_unpack("_best"))


def argmax_window(df: DataFrame, keys: Sequence[str], score: str = "score", pos: str = "pos",
                  text: str = "text") -> DataFrame:
    """Rank form of :func:`argmax` (W2); must return the same rows.

    Sorts every group, so it costs more than the aggregate form; kept as an
    independent cross-check and for callers that need the rank column.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(pos).asc())
    r = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return r.select(*keys, F.col(score).alias("best_score"), F.col(pos).alias("best_pos"),
                    F.col(text).alias("best_text"))


def speaker_bests(df: DataFrame, keys: Sequence[str], score: str = "score", pos: str = "pos",
                  text: str = "text") -> DataFrame:
    """The user's and the agent's best sentence side by side, in one aggregate.

    Columns ``u`` and ``a`` are ``struct(score, neg_pos, text)`` or null.
    """
    b = best_struct(score, pos, text)
    return df.groupBy(*keys).agg(
        F.max(F.when(F.col("speaker") == "user", b)).alias("u"),
        F.max(F.when(F.col("speaker") == "agent", b)).alias("a"),
    )


def record_bests(df: DataFrame, keys: Sequence[str], score: str = "score", pos: str = "pos",
                 text: str = "text", speaker: str | None = None) -> DataFrame:
    """The best sentence(s) of every input record, one row per record.

    ``keys`` identify a record's content; records equal in all of them can't be told
    apart, so their sentences come in equal copies. The copies of the winning
    sentence are counted and the result row repeated that often. With ``speaker``
    the columns are ``u`` and ``a``, else ``best``; each is
    ``struct(score, neg_pos, text, copies)`` or null.

    Rows are dealt by ``keys`` once; both aggregates use that partitioning.
    """
    who = [speaker] if speaker else []
    each = df.repartition(*keys).groupBy(*keys, *who, pos).agg(
        F.max(F.struct(F.col(score).alias("score"), F.col(text).alias("text"))).alias("_v"),
        F.count(F.lit(1)).alias("_n"))
    b = F.struct(F.col("_v.score").alias("score"), (-F.col(pos)).alias("neg_pos"), F.col("_v.text").alias("text"),
                 F.col("_n").alias("copies"))
    if speaker:
        bests = [F.max(F.when(F.col(speaker) == w, b)).alias(c) for w, c in (("user", "u"), ("agent", "a"))]
    else:
        bests = [F.max(b).alias("best")]
    out = each.groupBy(*keys).agg(*bests)
    n = F.greatest("u.copies", "a.copies") if speaker else F.col("best.copies")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), n))).drop("_copy")


def choose(u: Column, a: Column, mode: str = "intended") -> Column:
    """Pick the record's result from the two bests (A2).

    Missing bests count as score 0.0 with empty text, as in the reference.
    ``intended``: the user's when strictly higher, else the agent's.
    ``faithful``: the reference's code as written — its agent branch yields the
    user's pair, so the user's best (or a blank 0.0 row) is what is emitted.
    Returns ``struct(speaker, score, text)`` or null.
    """
    us = F.coalesce(u["score"], F.lit(0.0))
    ks = F.coalesce(a["score"], F.lit(0.0))
    user = F.struct(F.lit("user").alias("speaker"), us.alias("score"),
                    F.coalesce(u["text"], F.lit("")).alias("text"))
    agent = F.struct(F.lit("agent").alias("speaker"), ks.alias("score"),
                     F.coalesce(a["text"], F.lit("")).alias("text"))
    if mode == "intended":
        second = agent
    elif mode == "faithful":
        second = user
    else:
        raise ValueError(f"unknown select mode {mode!r}")
    return F.when((us > ks) & u.isNotNull(), user).when((us <= ks) & a.isNotNull(), second)
