"""Quantiles from counts in value bins.

A first pass counts a column's values in fixed, logarithmic bins.  Such counts merge by
adding, in any order, so the answer never follows the layout of the data.
Where the bin that holds a wanted rank has more than the allowed share of all rows,
it alone is counted again, in finer bins between its least and its greatest value,
until it is small enough or holds one value.  The value returned is always
a value of the column, and its rank is off by at most ``relative_error`` times the
number of rows: the error is a bound, not an estimate.  Error 0 gives exact
discrete quantiles, whatever the number of distinct values.

Each pass is one partial aggregate over at most some 10^5 bins (4,096 for each wanted rank after the first
pass); one small row reaches the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins for each factor of e in the first pass, and for each range counted again.
LOG_BINS, LINEAR_BINS = 256, 4096

#: More than the bins below 1 (the least double has a logarithm of about -745).
_BELOW_ONE = 200_000


def log_bin(value: Column) -> Column:
    """Number of the fixed bin of a double: rises with the value, 0 for zero."""
    def size(x: Column) -> Column:
        return F.floor(F.least(F.log(x), F.lit(710.0)) * LOG_BINS) + _BELOW_ONE
    return F.when(value == 0, F.lit(0)).when(value > 0, size(value)).otherwise(-size(-value)).cast("long")


def value_bins(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """The sketch as a table: ``(column, bin, n, lo, hi)``, n being the rows (or the
    summed ``weight``) of a bin.  Null and NaN are left out.  Tables of parts of
    the data merge by ``merged_bins``."""
    return _binned(_long(df, columns, weight), log_bin(F.col("v")))


def merged_bins(*tables: DataFrame) -> DataFrame:
    whole = reduce(DataFrame.unionByName, tables)
    return whole.groupBy("column", "bin").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _long(df: DataFrame, columns: Sequence[str], weight: str | None) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    rows = df.select((F.col(weight).cast("long") if weight else F.lit(1).cast("long")).alias("w"),
                     F.explode(cells).alias("c")).select("w", "c.column", "c.v")
    return rows.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("w") > 0))


def _binned(rows: DataFrame, number: Column) -> DataFrame:
    return rows.groupBy("column", number.alias("bin")).agg(
        F.sum("w").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def _wanted(bins: DataFrame, ranks: Column) -> DataFrame:
    """For each column the bins that hold its wanted ranks: ``(column, total, found)``.
    ``ranks``: array of ranks (doubles), as a function of ``total``."""
    listed = bins.groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("bin", "n", "lo", "hi"))).alias("bins"), F.sum("n").alias("total"))
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("n"),
                     F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))

    def hold(rank: Column) -> Column:
        return F.aggregate("bins", start, lambda a, b: F.when(
            (a["before"] + a["n"] >= rank) & a["lo"].isNotNull(), a).otherwise(F.struct(
                (a["before"] + a["n"]).alias("before"), b["n"].alias("n"), b["lo"].alias("lo"), b["hi"].alias("hi"))))

    return listed.select("column", "total", F.transform(ranks, hold).alias("found"))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], relative_error: float,
                     weight: str | None = None) -> dict[str, list[float | None]]:
    """The ``probs``-quantiles of several columns, by name; null for a column without values.

    The wanted rank is ``p`` times the number of rows (or the summed
    ``weight``), and the exact answer is the first value that reaches it."""
    if not 0 <= relative_error < 1:
        raise ValueError(f"relative error {relative_error!r} is not in [0, 1)")
    probs = [float(p) for p in probs]
    rows = _long(df, columns, weight)
    ranks = F.transform(F.array(*[F.lit(p) for p in probs]), lambda p: p * F.col("total").cast("double"))
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    open_: dict[tuple[str, int], tuple] = {}                   # (column, place) -> before, n, lo, hi, total
    for r in _wanted(_binned(rows, log_bin(F.col("v"))), ranks).collect():
        for i, f in enumerate(r["found"]):
            open_[r["column"], i] = (f["before"], f["n"], f["lo"], f["hi"], r["total"])
    while open_:
        wide = {}
        for (c, i), (before, n, lo, hi, total) in open_.items():
            if lo == hi or n <= relative_error * total:
                out[c][i] = hi
            else:
                wide[c, i] = (before, n, lo, hi, total)
        open_ = _narrowed(rows, wide, probs) if wide else {}
    return out


def _narrowed(rows: DataFrame, wide: Mapping[tuple[str, int], tuple], probs: Sequence[float]) -> dict:
    """Each wide bin counted again in finer ones; the finer one that holds the rank."""
    ranges = sorted({(c, lo, hi) for (c, _), (_, _, lo, hi, _) in wide.items()})
    part = fine = None
    for k, (c, lo, hi) in enumerate(ranges):
        inside = (F.col("column") == c) & F.col("v").between(lo, hi)
        step = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * LINEAR_BINS), F.lit(LINEAR_BINS - 1))
        part = F.when(inside, F.lit(k)) if part is None else part.when(inside, F.lit(k))
        # the greatest value has the last bin for itself: every pass parts least from greatest
        step = F.when(F.col("v") == F.lit(hi), F.lit(LINEAR_BINS)).otherwise(step)
        fine = F.when(part.isNotNull() & inside, step) if fine is None else fine.when(inside, step)
    finer = _binned(rows.select("w", "v", part.cast("string").alias("column"), fine.cast("long").alias("_bin"))
                    .where(F.col("column").isNotNull()), F.col("_bin"))
    keys = list(wide)
    number = {r: str(k) for k, r in enumerate(ranges)}
    out = {}
    by_range: dict[str, list] = {}
    for (c, i) in keys:
        before, _, lo, hi, total = wide[c, i]
        by_range.setdefault(number[c, lo, hi], []).append(((c, i), probs[i] * total - before, before, total))
    ranks = F.array().cast("array<double>")
    for name, asked in by_range.items():
        ranks = F.when(F.col("column") == name, F.array(*[F.lit(float(r)) for _, r, _, _ in asked])).otherwise(ranks)
    for r in _wanted(finer, ranks).collect():
        for (key, _, before, total), f in zip(by_range[r["column"]], r["found"]):
            out[key] = (before + f["before"], f["n"], f["lo"], f["hi"], total)
    return out


def rank_check(df: DataFrame, column: str, values: Mapping[float, float], relative_error: float) -> DataFrame:
    """Where given quantiles stand: ``(prob, value, n_rows, n_below, n_upto, within_error)``,
    counted over all rows in one pass."""
    v = F.col(column).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*[F.struct(
        F.lit(float(p)).alias("prob"), F.lit(float(x)).alias("value"), F.count_if(v < x).alias("n_below"),
        F.count_if(v <= x).alias("n_upto")) for p, x in values.items()]).alias("q"))
    q = counts.select("n_rows", F.explode("q").alias("q")).select("q.prob", "q.value", "n_rows", "q.n_below", "q.n_upto")
    rank, slack = F.col("prob") * F.col("n_rows"), F.lit(float(relative_error)) * F.col("n_rows")
    # the value's ranks are n_below + 1 to n_upto: the wanted one is among them but for the slack
    return q.withColumn("within_error", (F.col("n_below") < F.col("n_upto")) & (F.col("n_below") <= rank + slack)
                        & (F.col("n_upto") >= rank - slack))
