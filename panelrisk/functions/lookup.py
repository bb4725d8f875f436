"""Dictionary lookups as constant-folded map expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A literal ``map<string,string>`` (constant-folded by Catalyst)."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])


def translate(c, mapping: Mapping[str, str]) -> Column:
    """Whole-value replacement with pass-through: a value equal to a key
    is replaced by its target, any other value (and null) is kept.  One
    pass, never chained (``a->b, b->a`` swaps)."""
    c = as_col(c)
    if not mapping:
        return c
    return F.coalesce(map_literal(mapping)[c], c)


def label_or_default(c, mapping: Mapping, default: str) -> Column:
    """``mapping.get(key, default)`` without a Python UDF."""
    c = as_col(c)
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for x in chain(*mapping.items())])
    return F.coalesce(m[c], F.lit(default))
