"""Casts that never throw under ANSI mode (Spark 4 default)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def safe_double(c) -> Column:
    """Any value -> double; unparsable text -> null (no ANSI error)."""
    return as_col(c).try_cast("double")


def safe_int(c) -> Column:
    """Any value -> int via double, so ``'2020.0'`` -> 2020 (a direct
    ``try_cast('2020.0' as int)`` is null); fractions truncate toward
    zero as a cast does, out-of-range values become null."""
    d = as_col(c).try_cast("double")
    return d.try_cast("int")


def nan_to_null(c) -> Column:
    """Normalise NaN to null (pandas treats both as missing; Spark does not)."""
    c = as_col(c)
    return F.nanvl(c, F.lit(None).cast("double"))
