"""Column expressions for tokenising, cleaning and scoring text.

Everything here returns a ``Column`` built from JVM-side functions, so it runs
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from convaudit.config import FILTER_CHARS

WORD_PATTERN = r"[\p{L}\p{N}]+"
# Han characters become one token each; runs of other letters/digits stay whole.
HAN_CHAR_PATTERN = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"
HAN_RUN_PATTERN = r"\p{IsHan}{2,}"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col: Column | str, han_mode: str = "none") -> Column:
    """Lower-case ``col`` and split it into letter/digit runs.

    ``han_mode``: ``none`` keeps a Han run as one token (matches the oracle
    regex), ``char`` splits Han text into single characters, ``bigram`` adds
    the overlapping two-character grams of every Han run to the ``char`` tokens.
    This stands in for dictionary word segmentation; it is not equal to it.
    """
    low = F.lower(_c(col))
    if han_mode == "none":
        return F.regexp_extract_all(low, F.lit(WORD_PATTERN), 0)
    chars = F.regexp_extract_all(low, F.lit(HAN_CHAR_PATTERN), 0)
    if han_mode == "char":
        return chars
    if han_mode != "bigram":
        raise ValueError(f"unknown han_mode {han_mode!r}")
    runs = F.regexp_extract_all(low, F.lit(HAN_RUN_PATTERN), 0)
    grams = F.flatten(F.transform(
        runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2))))
    return F.concat(chars, grams)


def split_ws(col: Column | str) -> Column:
    """Whitespace split without empty pieces (pre-tokenised input)."""
    return F.filter(F.split(_c(col), r"\s+"), lambda t: t != F.lit(""))


def clean_tokens(tokens: Column | str, filter_chars: str = FILTER_CHARS) -> Column:
    """Drop tokens made only of filter characters (punctuation, spaces, newlines)."""
    return F.filter(_c(tokens), lambda t: F.translate(t, filter_chars, "") != F.lit(""))


def lower_all(tokens: Column | str) -> Column:
    return F.transform(_c(tokens), F.lower)


def term_hits(tokens: Column | str, terms: Sequence[str]) -> Column:
    """Number of tokens equal to one of ``terms`` (a small fixed list)."""
    arr = F.array(*[F.lit(t) for t in terms])
    return F.size(F.filter(_c(tokens), lambda t: F.array_contains(arr, t)))


def ratio_score(tokens: Column | str, terms: Sequence[str]) -> Column:
    """Deterministic stand-in for a model score: term hits / token count.

    A ratio of two integers, so it is exact in every engine. Null for no tokens.
    """
    n = F.size(_c(tokens))
    return F.when(n > 0, term_hits(tokens, terms).cast("double") / n.cast("double"))


def compare(left: Column, op: str, right: Column | float) -> Column:
    """``left <op> right`` with the comparison chosen by parameter; NaN never passes."""
    r = right if isinstance(right, Column) else F.lit(float(right))
    ops = {">": left > r, ">=": left >= r, "<": left < r, "<=": left <= r}
    if op not in ops:
        raise ValueError(f"unsupported comparison {op!r}")
    return ops[op] & ~F.isnan(left)
