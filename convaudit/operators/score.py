"""Sentence scorers and score arithmetic (ratio scorer, F1, A10).

A scorer is any callable ``DataFrame -> DataFrame`` that adds a ``score``
column (the probability that the sentence is negative) to a frame carrying a
``tokens`` array. ``RatioScorer`` is a deterministic stand-in used where a
model would be; ``convaudit.ml.score.ModelScorer`` wraps fitted Spark ML
pipelines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convaudit.config import EMOTION_WEIGHTS
from convaudit.functions.text import ratio_score


@dataclass(frozen=True)
class RatioScorer:
    """score = (tokens equal to a term) / (tokens)."""

    terms: tuple[str, ...]
    tokens: str = "tokens"
    out: str = "score"

    def __call__(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.out, ratio_score(self.tokens, list(self.terms)))

    def column(self, tokens: Column) -> Column:
        """The score as an expression of a token array (lets plans score inside a row)."""
        return ratio_score(tokens, list(self.terms))


def blend(score: Column, emotion: Column, weights: tuple[float, float] = EMOTION_WEIGHTS) -> Column:
    """``w0 * score + w1 * emotion`` (F1); null when either input is null."""
    w0, w1 = weights
    return F.lit(float(w0)) * score + F.lit(float(w1)) * emotion.cast("double")


def mean_of(cols: Sequence[Column]) -> Column:
    """Ensemble mean of several model scores (A10)."""
    if not cols:
        raise ValueError("no score columns")
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))
