"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column absent from a frame is null
    there (pandas ``concat``).  No shuffle."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
