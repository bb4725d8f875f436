"""Forecasting: temporal split, regression metrics, quantile risk zones and the
single-entity report.  The forest itself is in ``forest``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.bands import upper_inclusive_zone
from .aggregates import quantile_values
from .forest import Forest, fit_forest
from .setops import union_by_name


__all__ = ["Forest", "entity_report", "fit_forest", "quantile_zones", "regression_metrics", "split_value",
           "temporal_split"]


def split_value(df: DataFrame, year_col: str = K.YEAR, q: float = K.SPLIT_QUANTILE,
                relative_error: float = K.SPLIT_RELATIVE_ERROR) -> int:
    """The split year: the q-quantile of year (one small aggregate job)."""
    return int(quantile_values(df, year_col, [q], relative_error)[0])


def temporal_split(df: DataFrame, year_col: str = K.YEAR, q: float = K.SPLIT_QUANTILE,
                   relative_error: float = K.SPLIT_RELATIVE_ERROR) -> tuple[Column, DataFrame, DataFrame]:
    """``(split, train, test)``: train is ``year <= split``, test ``year >
    split`` where split is the q-quantile of year.

    The split year is fetched once (a one-number aggregate, as
    ``approxQuantile`` does) and the filters carry it as a literal: a
    year-partitioned source then prunes partitions statically, and the
    filters stay plain constraints for the optimizer."""
    s = F.lit(split_value(df, year_col, q, relative_error))
    return s, df.filter(F.col(year_col) <= s), df.filter(F.col(year_col) > s)


def regression_metrics(pred: DataFrame, label: str = K.VAL,
                       prediction: str = K.PREDICTION) -> DataFrame:
    """``(n, r_squared, rmse, mae)`` in one aggregate pass (the three
    evaluator calls of the original would scan the predictions thrice).
    Total sum of squares comes from ``var_pop`` (a numerically stable,
    mergeable central moment).  A constant label has no r_squared (null);
    without rows all three are null."""
    y, p = F.col(label), F.col(prediction)
    e = y - p
    agg = pred.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"),
                   F.sum(F.abs(e)).alias("sae"), F.var_pop(y).alias("vy"))
    return agg.select(
        "n",
        (1.0 - F.try_divide(F.col("sse"), F.col("vy") * F.col("n"))).alias("r_squared"),
        F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("rmse"),
        F.try_divide(F.col("sae"), F.col("n")).alias("mae"))


def quantile_zones(pred: DataFrame, column: str = K.PREDICTION,
                   probs: Sequence[float] = tuple(K.ZONE_QUANTILES),
                   relative_error: float = K.ZONE_RELATIVE_ERROR,
                   labels: Sequence[str] = K.ZONE_LABELS, out: str = K.ZONE) -> DataFrame:
    """Cut ``column`` at its own quantiles into upper-inclusive zones.  The two cuts
    are literals; the sketch that gives them does not follow the layout of the rows."""
    lo, hi = quantile_values(pred, column, list(probs), relative_error)
    return pred.withColumn(out, upper_inclusive_zone(column, lo, hi, labels))


def entity_report(scored: DataFrame, history: DataFrame, entity: str = K.TARGET_ENTITY,
                  entity_col: str = K.TRANSLATED,
                  scored_cols: Sequence[str] = (K.TRANSLATED, K.YEAR, K.MEASURE, K.VAL, K.PREDICTION,
                                                K.ZONE, K.GDP, K.POP, K.PROFILE),
                  history_cols: Sequence[str] = (K.TRANSLATED, K.YEAR, K.VAL, K.PROFILE)) -> DataFrame:
    """Scored rows of one entity; when it has none, its history instead.
    Rows come in order of year, then of all other columns; a ``source``
    column says which they are.  Whether any scored row exists is a
    ``limit(1)`` probe (stops at the first match)."""
    hit = scored.filter(F.col(entity_col) == F.lit(entity)).select(*scored_cols)
    if hit.limit(1).count() > 0:
        out = hit.withColumn("source", F.lit("scored"))
    else:
        hist = history.filter(F.col(entity_col) == F.lit(entity)).select(*history_cols)
        out = union_by_name(hit.withColumn("source", F.lit("scored")), hist.withColumn("source", F.lit("history")))
    return out.orderBy(K.YEAR, *[c for c in out.columns if c != K.YEAR])
