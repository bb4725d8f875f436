"""Aggregations and reports.  Each report is a single pass (one job) that
returns a small DataFrame; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from .sketch import column_quantiles


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source and the grand total: ``(source, rows)``; total has
    ``source = 'TOTAL'``.  Each source is a partial count (no data shuffle)."""
    parts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        parts = one if parts is None else parts.unionByName(one)
    total = parts.agg(F.sum("rows").alias("rows")).select(F.lit("TOTAL").alias("source"), "rows")
    return parts.unionByName(total)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column in one pass (NaN is *not* counted, as in the
    original report)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.  ``approx`` uses HyperLogLog++
    (fixed memory per column whatever the cardinality)."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Non-null distinct values of a column."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def group_means(df: DataFrame, keys: Sequence[str], means: Mapping[str, str],
                order_by: Sequence[str] | None = None) -> DataFrame:
    """``groupBy(keys).agg(avg...)`` (partial + final hash aggregate),
    optionally ordered."""
    out = df.groupBy(*keys).agg(*[F.avg(src).alias(dst) for dst, src in means.items()])
    return out.orderBy(*order_by) if order_by else out


def distribution(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                 count_name: str = "count") -> DataFrame:
    """Rows per group, ordered by the keys."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    return out.orderBy(*(order_by or keys))


def quantiles(df: DataFrame, column: str, probs: Sequence[float], relative_error: float,
              names: Sequence[str] | None = None) -> DataFrame:
    """One-row frame of ``quantile_values`` (null for a column without values)."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    found = column_quantiles(df, [column], probs, relative_error)[column]
    return df.sparkSession.range(1).select(*[F.lit(v).cast("double").alias(n) for n, v in zip(names, found)])


def quantile_values(df: DataFrame, column: str, probs: Sequence[float],
                    relative_error: float) -> list:
    """The quantiles as Python numbers (what ``approxQuantile`` returns), to
    be used as literals in the consuming plan.  Nulls and NaN are ignored.

    They come from counts in value bins (``sketch``): values of the column, off
    by at most ``relative_error`` of all ranks, the same for any layout of the rows; 0 is
    exact, whatever the number of distinct values."""
    vals = column_quantiles(df, [column], probs, relative_error)[column]
    if any(v is None for v in vals):
        raise ValueError(f"quantiles of {column} cannot be computed: no values")
    return vals


def split_summary(df: DataFrame, split: Column | int, year_col: str = K.YEAR) -> DataFrame:
    """``(split_year, training_rows, testing_rows)`` in one pass."""
    s = split if isinstance(split, Column) else F.lit(int(split))
    return df.agg(F.count_if(F.col(year_col) <= s).alias("training_rows"),
                  F.count_if(F.col(year_col) > s).alias("testing_rows")) \
             .select(s.cast("int").alias("split_year"), "training_rows", "testing_rows")
