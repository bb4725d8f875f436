"""Sharding along a Hilbert curve over document metadata, in DataFrame functions only.

Language, source and size are quantised to cells of a grid, documents are
ordered by the cell's place on the Hilbert curve, and the order is cut into
runs.  Documents near each other on the curve are alike in all dimensions, so
a shard covers a small box of each and readers can skip whole shards by any of
them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import ranked, stage, with_small_table

#: Bits of each quantised dimension.
BITS = 5


def hilbert_index(axes: list[str], bits: int = BITS) -> str:
    """SQL for the place on the Hilbert curve of the cell with these integer
    coordinates (each in [0, 2**bits)).

    Skilling's transform, bit by bit from the top: a set bit of an axis flips
    the lower bits of the first axis, a clear one swaps them with the first
    axis's; then Gray coding, and the bits are interleaved."""
    n = len(axes)
    x = [f"a.x{i}" for i in range(n)]
    start = ", ".join(f"int({c}) AS x{i}" for i, c in enumerate(axes))

    def put(i: int, value: str, at0: str | None = None) -> str:
        new = list(x)
        new[i] = value
        if at0:
            new[0] = at0
        return "named_struct(" + ", ".join(f"'x{k}', {v}" for k, v in enumerate(new)) + ")"

    low = "(shiftleft(1, s.b) - 1)"
    cases = []
    for i in range(n):
        flip = put(0, f"a.x0 ^ {low}")
        swap = put(i, f"a.x{i} ^ ((a.x0 ^ a.x{i}) & {low})",
                   f"a.x0 ^ ((a.x0 ^ a.x{i}) & {low})" if i else None)
        keep = put(0, "a.x0") if i == 0 else swap
        cases.append(f"WHEN s.i = {i} THEN CASE WHEN (a.x{i} & shiftleft(1, s.b)) <> 0 THEN {flip} ELSE {keep} END")
    steps = "array(" + ", ".join(
        f"named_struct('b', {b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(n)) + ")"
    undone = f"aggregate({steps}, struct({start}), (a, s) -> CASE {' '.join(cases)} END)"

    gray, terms = [], []
    for i in range(n):
        gray.append("a.x0" if i == 0 else f"{gray[-1]} ^ a.x{i}")
    t = " ^ ".join(f"(CASE WHEN (({gray[-1]}) & {1 << b}) <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
                   for b in range(bits - 1, 0, -1))
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            bit = f"(shiftright(({gray[i]}) ^ {t}, {b}) & 1)"
            terms.append(f"shiftleft({bit}, {b * n + n - 1 - i})")
    # one-element transform: names the undone axes once
    return f"transform(array({undone}), a -> {' + '.join(terms)})[0]"


def ordinal_cells(rows: DataFrame, col: str, bits: int, name: str) -> DataFrame:
    """``col`` and its cell: the place of each distinct value among the
    distinct values in their order, scaled to the grid.  Null comes first."""
    distinct = ranked(rows.select(col).distinct(), [F.col(col).asc_nulls_first()], name, "place")
    n = distinct.count()
    return distinct.select(col, F.expr(f"int(place * {1 << bits} div {max(n, 1)}L)").alias(f"{col}_cell"))


def hilbert_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   dims: tuple[str, ...] = ("lang", "source"), bits: int = BITS) -> DataFrame:
    """One row for each document: ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``, then ``curve_index``.

    Law ``rows``: the shards' document counts are at most one apart.
    Documents are ordered by (curve index, id, text checksum); ``shard`` is
    the run that a document's place falls into and ``slot`` its place in that
    run.  Size is the text's UTF-8 bytes plus 1; a null text has none, and
    the checksum of the empty text.  Null metadata and null ids sort first.
    Repeated rows get places of their own.  Fewer documents than shards leave
    shards empty; an empty table gives an empty result.  A dimension that the
    table lacks is an error."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"), *[F.col(d).alias(f"d{i}") for i, d in enumerate(dims)],
        size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")), "shard-rows")
    axes = []
    for i in range(len(dims)):
        cells = ordinal_cells(rows, f"d{i}", bits, f"cells-{i}")
        rows = with_small_table(rows, cells, [f"d{i}"], "doc_id")
        axes.append(f"d{i}_cell")
    # sizes by octave
    axes.append(f"least(length(bin(size)), {(1 << bits) - 1})")
    keyed = rows.select("doc_id", "size", "text_crc32", F.expr(hilbert_index(axes, bits)).alias("curve_index"))
    placed = ranked(keyed, [F.col("curve_index"), F.col("doc_id").asc_nulls_first(), F.col("text_crc32")],
                    "shard-order", "place")
    n = max(placed.count(), 1)
    shard = F.expr(f"int(place * {shards} div {n}L)")
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")  # least place of the run
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "curve_index"))
