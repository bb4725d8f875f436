"""Ordering operators: top-k, repeatable bounded samples, first-by-order
and ordered-category sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.bands import ordinal


def top_k(df: DataFrame, order_by: Sequence[Column], k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The ``k`` first rows under a total order (planned as
    ``TakeOrderedAndProject``: each task keeps only its own top ``k``)."""
    out = df.select(*columns) if columns else df
    return out.orderBy(*order_by).limit(k)


def repeatable_sample(df: DataFrame, n: int, key: Column | None = None,
                      condition: Column | None = None) -> DataFrame:
    """``n`` rows chosen by a deterministic key (default: a hash of all
    columns) instead of "whatever comes first", so reruns and different
    partitionings give the same rows.  Also a top-k plan."""
    if condition is not None:
        df = df.filter(condition)
    key = key if key is not None else F.xxhash64(*[F.col(c) for c in df.columns])
    return df.orderBy(key, *[F.col(c) for c in df.columns]).limit(n)


def first_by_order(df: DataFrame, value: str, order_by: Sequence[str | Column],
                   keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """``value`` of the first row under ``order_by`` (per key when given):
    a partial aggregate, never a sort of the whole frame."""
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    return df.groupBy(*keys).agg(F.min_by(F.col(value), order).alias(out or value))


def ordered_category_sort(df: DataFrame, column: str = K.ZONE,
                          order: Sequence[str] = K.ZONE_LABELS,
                          tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sort by the position of a label in ``order``; other labels and null
    go last."""
    return df.orderBy(ordinal(column, order).asc_nulls_last(), *tiebreak)
