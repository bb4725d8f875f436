"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks.  With weight w, its k-th block (from 1) is
released at slot floor((k - 1) / w) and due by slot ceil(k / w); giving each
slot to the released block with the earliest deadline keeps every source
within one block of its share w * t at every slot t.

The slots are scheduled in periods that do not wait for one another.  What each source
has had by the end of a period follows from its share there: the whole blocks of the
share, and one more for the sources with the largest remainders, so that the
slots so far are used up.  Rounding is thus made anew at every border and
does not add up.  Within a period the windows are those of the weights themselves.
Sources are a table, and each period is a group of its rows, one for each source that still lasts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelrisk.llm.common import null_safe_join, ranked, stage, with_small_table

#: Least slots of a period; it has four slots for each source at least.
PERIOD = 4096

#: Weights are whole multiples of their sum over about this number.
UNITS = 1 << 48


def shares(weights: Sequence[int], total: int, slot: int) -> list[int]:
    """Blocks that each of some sources has had when ``slot`` begins: its share rounded
    down, or up for those with the largest remainders (ties in their order).
    ``weights`` are numbers of ``total`` parts."""
    had = [w * slot // total for w in weights]
    rest = [w * slot % total for w in weights]
    more = (2 * sum(rest) + total) // (2 * total)
    for i in sorted(range(len(weights)), key=lambda i: (-rest[i], i))[:more]:
        had[i] += 1
    return had


def one_period(number: int, slots: int, total: int, sources: Sequence[tuple[int, int, bool, bool]]) -> Iterator[tuple]:
    """(source's index, block, slot, release, deadline) of period ``number``, whose borders are
    multiples of ``slots``, by earliest deadline first among released blocks.

    ``sources``: weight in parts of ``total``, number of blocks, whether the source lasts in the
    period before, whether in this one.  The block after a source's last one
    competes as well (it tells when the source has run out); later ones do not."""
    begin, end = number * slots, (number + 1) * slots
    before = [i for i, x in enumerate(sources) if x[2]] if number else []
    now = [i for i, x in enumerate(sources) if x[3]]
    first = dict(zip(before, shares([sources[i][0] for i in before], total, begin)))
    last = dict(zip(now, shares([sources[i][0] for i in now], total, end)))
    waiting: list[tuple[int, int, int]] = []

    def wait(i: int, k: int) -> None:
        if k < min(last[i], sources[i][1] + 1):
            heapq.heappush(waiting, (k * total // sources[i][0], i, k))

    for i in now:
        wait(i, first.get(i, 0))
    ready: list[tuple[int, int, int]] = []
    slot = begin
    while slot < end and (waiting or ready):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * total // sources[i][0]), i, k))
        if ready:
            due, i, k = heapq.heappop(ready)
            yield i, k, slot, k * total // sources[i][0], due
            wait(i, k + 1)
            slot += 1
        else:
            slot = waiting[0][0]


def weighted_sources(counts: DataFrame, weights: Mapping[str | None, float] | DataFrame | None,
                     power: float) -> DataFrame:
    """``counts`` (``source, n, ...``) with a positive ``weight``: from ``weights``, or ``n`` to the ``power``."""
    if weights is None:
        return counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(power))))
    if not isinstance(weights, DataFrame):
        weights = counts.sparkSession.createDataFrame(
            [(s, float(w)) for s, w in weights.items()], "source string, weight double")
    found = null_safe_join(counts, weights.select("source", F.col("weight").cast("double").alias("weight")), ["source"])
    if missing := found.where(F.coalesce(F.col("weight") <= 0, F.lit(True))).limit(5).collect():
        raise ValueError(f"no positive weight for sources {[r['source'] for r in missing]}")
    return found


def schedule(sources: DataFrame, period: int | None = None) -> tuple[DataFrame, int]:
    """``(source, block, slot, release, deadline, over)`` of every block of ``sources``
    (``source, blocks, weight``), and the length of a period.  ``over`` marks the row after a
    source's last block.

    A weight below two slots of a period counts as two: every source has a block
    in each period that it lasts, so there are no more rows than blocks, and one for each source."""
    sums = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).first()
    if not sums["n"]:
        return sources.select("source", *[F.lit(0).cast("long").alias(c) for c in ("block", "slot", "release", "deadline")],
                              F.lit(False).alias("over")), PERIOD
    period = max(period or PERIOD, 1 << (4 * sums["n"] - 1).bit_length())
    least = -(-2 * UNITS // period)
    parts = F.greatest(F.floor(F.col("weight") / F.lit(sums["w"]) * F.lit(float(UNITS))), F.lit(least)).cast("long")
    sources = stage(sources.select("source", "blocks", parts.alias("parts")), "mix-sources")
    total = int(sources.agg(F.sum("parts")).first()[0])
    # a source lasts at most until the period that holds the block after its last one
    until = F.floor((F.col("blocks") + 2).cast("double") * F.lit(float(total)) / F.col("parts") / F.lit(float(period))) + 1
    rows = sources.withColumn("until", until.cast("long")).select(
        "source", "blocks", "parts", "until", F.explode(F.sequence(F.lit(0).cast("long"), F.col("until") + 1)).alias("period"))
    schema = pa.schema([("source", pa.string()), ("block", pa.int64()), ("slot", pa.int64()), ("release", pa.int64()),
                        ("deadline", pa.int64()), ("over", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        for number, group in groupby(lines, key=lambda r: r[0]):
            group = sorted(group, key=lambda r: (r[1] is not None, r[1] or ""))
            known = [(parts, blocks, number <= until + 1, number <= until) for _, _, blocks, parts, until in group]
            out = [(group[i][1], k, slot, release, due, k == known[i][1])
                   for i, k, slot, release, due in one_period(number, period, total, known)]
            for x in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[x:x + 10_000]), schema)],
                                                 schema=schema)

    planned = rows.select("period", "source", "blocks", "parts", "until").repartition("period").sortWithinPartitions(
        "period").mapInArrow(run, "source string, block long, slot long, release long, deadline long, over boolean")
    return stage(planned, "mix-schedule"), period


def mix(docs: DataFrame, weights: Mapping[str | None, float] | DataFrame | None = None, *, id_col: str = "doc_id",
        source_col: str = "source", block: int = 16, power: float = 0.5, seed: int = 7,
        period: int | None = None) -> DataFrame:
    """One row for each document: ``doc_id, source, block, slot, release,
    deadline, position, on_target``.

    ``weights`` gives each source's target share (any positive numbers, as a mapping
    or as a table ``source, weight``); by
    default it is the source's number of documents to the ``power``, which
    lifts small sources.  Sources that are absent from ``weights`` are an
    error; weights below two slots of a period (``schedule``) count as two.
    A source's documents are put in an order drawn by a hash of the
    id and cut into blocks of ``block``.  ``position`` (0, 1, ...) is the
    place of the document in the mixed order: blocks by slot, then the order
    in the block.  No document is dropped or repeated; ``on_target`` is true
    for blocks before the slot where the first source has run out: up to
    there every source is within one block of its share, however many periods
    there are, and what follows interleaves the sources that are left.

    A null source is a source of its own.  Null ids come first in their
    source's order; rows that tie on the id keep places of their own.  An
    empty table gives an empty result."""
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source")),
                 "mix-rows")
    drawn = stage(ranked(rows.withColumn("_drawn", F.xxhash64(F.col("doc_id"), F.lit(seed))),
                         [F.col("source").asc_nulls_first(), F.col("_drawn"), F.col("doc_id").asc_nulls_first()],
                         "mix-drawn", "_place"), "mix-placed")
    counts = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("_first"))
    counts = stage(weighted_sources(counts, weights, power), "mix-counts")
    plan, _ = schedule(counts.select("source", F.ceil(F.col("n") / block).cast("long").alias("blocks"), "weight"), period)
    out_at = plan.where("over").agg(F.min("slot")).first()[0]
    blocks = (with_small_table(drawn, counts.select("source", "_first"), ["source"], "doc_id")
              .withColumn("_of_source", F.col("_place") - F.col("_first"))
              .withColumn("block", F.expr(f"_of_source div {int(block)}")))
    slotted = (null_safe_join(blocks, plan.where(~F.col("over")).drop("over"), ["source", "block"], "inner")
               .withColumn("on_target", F.col("slot") < F.lit(0 if out_at is None else out_at)))
    placed = ranked(slotted.select("doc_id", "source", "block", "slot", "release", "deadline", "on_target",
                                   "_of_source"),
                    [F.col("slot"), F.col("_of_source")], "mix-order", "position")
    return placed.select("doc_id", "source", "block", "slot", "release", "deadline", "position", "on_target")


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *,
                   id_col: str = "doc_id", **options) -> DataFrame:
    """The documents themselves, all columns and rows, laid out in the mixed
    order: partitions are consecutive runs of positions, sorted.

    An id that several rows carry takes its first position.  Written as
    Parquet, the files in the order of their names hold the mix."""
    places = (mix(docs, weights, id_col=id_col, **options).groupBy("doc_id")
              .agg(F.min("position").alias("_mix_position")).withColumnRenamed("doc_id", id_col))
    return (null_safe_join(docs, places, [id_col])
            .repartitionByRange("_mix_position").sortWithinPartitions("_mix_position").drop("_mix_position"))
