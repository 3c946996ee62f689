"""Small plan helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(value: Column, pred: Callable[[Column], Column] | None = None) -> Column:
    """Generator giving ``value`` once when it is non-null (and passes ``pred``), else no row.

    Used instead of ``select(value).where(value is not null)``: the optimizer
    pushes such a filter below the projection and substitutes the expression,
    so an expensive per-row computation would run once in the filter and again
    in the projection. A generator evaluates it once.
    """
    ok = (lambda x: x.isNotNull()) if pred is None else (lambda x: x.isNotNull() & pred(x))
    return F.explode(F.filter(F.array(value), ok))


def keep_where(df: DataFrame, col: str, pred: Callable[[Column], Column]) -> DataFrame:
    """Rows whose ``col`` is non-null and passes ``pred``, without a pushable filter.

    For columns computed by something expensive (a model's prediction): a plain
    ``where`` on them is pushed below the projection and the prediction would be
    computed twice per row.
    """
    others = [c for c in df.columns if c != col]
    return df.select(*others, present(F.col(col), pred).alias(col)).select(*df.columns)


#: Largest size of a side that is broadcast on a hint.
BROADCAST_BYTES = 64 << 20


def is_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the rows of ``df`` take at most ``max_bytes`` (text columns measured, 16 bytes for each other one)."""
    kinds = dict(df.dtypes)
    size = F.lit(0).cast("long")
    for c, kind in kinds.items():
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif kind == "array<string>":
            size = size + F.coalesce(F.octet_length(F.concat_ws("", c)), F.lit(0)) + 16 * F.greatest(F.size(c), F.lit(0)) + 16
        else:
            size = size + 16
    return (df.agg(F.sum(size)).first()[0] or 0) <= max_bytes


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its measured bytes are within ``max_bytes``.

    Above it the frame is returned unhinted and the join falls back to a shuffle
    join (AQE may still convert it at run time from measured sizes).
    """
    return maybe_broadcast(df, is_bounded(df, max_bytes))
