"""Places of rows in a total order, without a window over all rows and without
the driver seeing more than one number for each partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: ``monotonically_increasing_id`` holds the partition above this many bits, the row below.
ROW_BITS = 33


def numbered(df: DataFrame, order_by: Sequence[str | Column], out: str, first: int = 0,
             keep: Sequence[str] | None = None) -> DataFrame:
    """Rows with their place (``first``, ``first + 1``, ...) in the order of ``order_by``.

    The frame is range-partitioned, sorted and landed, each row keeping its
    place in its partition; the partitions' row counts, one small number
    for each, give the places where they begin.  A key that ties is one
    range, so ``order_by`` should tell rows apart; rows that tie on all of it
    get places in any order, fixed once landed.  ``keep``: the columns that are
    landed, where the order's own are not wanted any more."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    at = "__at"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    if keep is not None:
        placed = placed.select(*keep, at)
    placed = staged(placed, "lake", "numbered")
    part = F.shiftright(at, ROW_BITS)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    begin, starts = first, []
    for p in range(max(sizes, default=-1) + 1):
        starts.append(begin)
        begin += sizes.get(p, 0)
    offsets = F.split(F.lit(",".join(map(str, starts or [first]))), ",").cast("array<bigint>")
    row = F.col(at).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumn(out, F.get(offsets, part.cast("int")) + row).drop(at)
