"""First/last-per-key selection as *aggregates* rather than windows.

``row_number() over (partition by k order by ...)`` sorts every row of a
key inside one task, so a key holding a third of the data lands on one
executor.  ``min_by``/``max_by`` over a struct are ordinary declarative
aggregates: Spark runs them partially on the map side (one row per key per
task leaves the task) and the shuffle carries at most
``tasks x distinct keys`` rows, however skewed the keys are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def _order_struct(order_by: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple (an
    explicit, total order; unlike ``dropDuplicates`` the survivor is
    deterministic).  Null keys form one group, like pandas."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    packed = F.min_by(F.struct(*rest), _order_struct(order_by)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the row with the largest ``order_by`` tuple."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), _order_struct(order_by)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], year_col: str = K.YEAR,
                   seq_col: str = K.SEQ) -> DataFrame:
    """Newest row per key: highest year, ties to the first row in input
    order (lowest ``seq``)."""
    return keep_last(df, keys, [F.col(year_col), -F.col(seq_col)])
