"""Banding and grading expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ._util import as_col
from .casts import nan_to_null


def upper_inclusive_zone(c, low, mid, labels: Sequence[str] = K.ZONE_LABELS) -> Column:
    """``<= low`` -> labels[0], ``<= mid`` -> labels[1], else labels[2].
    ``low``/``mid`` may be literals or columns (e.g. scalar subqueries).
    Like the original, anything not ``<=`` either cut (also null) falls
    into the top band."""
    c = as_col(c)
    low = low if isinstance(low, Column) else F.lit(float(low))
    mid = mid if isinstance(mid, Column) else F.lit(float(mid))
    return (F.when(c <= low, labels[0])
             .when(c <= mid, labels[1])
             .otherwise(labels[2]))


def fixed_band(c, low: float = K.FIXED_LOW_CUT, high: float = K.FIXED_HIGH_CUT,
               labels: Sequence[str] = K.ZONE_LABELS) -> Column:
    """``> high`` -> top, ``> low`` -> middle, else bottom.  Missing values
    (null *and* NaN) go to the bottom band, as pandas comparisons do."""
    v = nan_to_null(as_col(c).cast("double"))
    return (F.when(v > F.lit(float(high)), labels[2])
             .when(v > F.lit(float(low)), labels[1])
             .otherwise(labels[0]))


def profile_from_zone(zone, prefix: str = K.PROFILE_PREFIX) -> Column:
    """Profile text from a zone label (``"Risiko " + zone``)."""
    return F.concat(F.lit(prefix), as_col(zone))


def grade(c, bands: Sequence[tuple[float, str]], floor: str) -> Column:
    """First band whose threshold the value reaches (``>=``), else ``floor``."""
    c = as_col(c)
    expr = None
    for thr, name in bands:
        expr = (F.when(c >= F.lit(float(thr)), name) if expr is None
                else expr.when(c >= F.lit(float(thr)), name))
    return expr.otherwise(floor) if expr is not None else F.lit(floor)


def ordinal(c, order: Sequence[str] = K.ZONE_LABELS) -> Column:
    """Rank of a label in ``order`` (0-based); other values and null -> null,
    so ``asc_nulls_last`` puts them after the known labels."""
    c = as_col(c)
    expr = None
    for i, lab in enumerate(order):
        expr = F.when(c == lab, F.lit(i)) if expr is None else expr.when(c == lab, F.lit(i))
    return expr
