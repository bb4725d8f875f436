"""Feature steps: imputation, assembly, scaling, string indexing and a
deterministic data layout for model fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.casts import nan_to_null
from .joins import broadcastable, salted_left_join
from .ranks import numbered
from .sketch import column_quantiles


def median_impute(df: DataFrame, columns: Sequence[str],
                  relative_error: float = K.IMPUTE_RELATIVE_ERROR,
                  by: Sequence[str] | None = None,
                  fit_on: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """Replace null/NaN in ``columns`` by the column's median.

    Global (default, as the original): the medians come from counts in value bins
    (``sketch``), all columns in one pass, and are inlined as literals.
    ``by=[keys]``: per-group medians from a grouped
    aggregate joined back on the keys (the join is planned by size).
    ``fit_on``: take the medians from these rows only (e.g. the training
    years, so test rows do not leak into the surrogate; or one row for each key of a
    join with the number of joined rows as ``weight``).  A column with no
    value at all raises, like ``Imputer.fit``."""
    cols = list(columns)
    clean = df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cols})
    source = clean if fit_on is None else fit_on
    if by:
        source = source.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in cols})
        aggs = [_median_expr(c, relative_error).alias(f"__m_{c}") for c in cols]
        med = source.groupBy(*by).agg(*aggs)
        j = clean.join(med, list(by), "left")
        return j.withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in cols}) \
                .drop(*[f"__m_{c}" for c in cols])
    medians = column_quantiles(source, cols, [0.5], relative_error, weight)
    for c in cols:
        if medians[c][0] is None:
            raise ValueError(f"median of {c} cannot be computed: the column has no values")
    return clean.withColumns({c: F.coalesce(F.col(c), F.lit(float(medians[c][0]))) for c in cols})


def _median_expr(c: str, relative_error: float):
    if relative_error == 0:
        return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)")
    return F.percentile_approx(c, 0.5, max(1, int(round(1 / relative_error))))


def assemble(df: DataFrame, inputs: Sequence[str], out: str = "features",
             handle_invalid: str = "skip") -> DataFrame:
    """Vector of ``inputs``; ``skip`` drops rows with null/NaN inputs."""
    return VectorAssembler(inputCols=list(inputs), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def standardize_columns(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / sample sd`` per column (what ``StandardScaler`` with
    mean and sd does; sd 0 gives 0).  Means and sds come from one aggregate
    job and enter the plan as literals."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                 *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]).first()
    out = {}
    for c in columns:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        if m is None:
            raise ValueError(f"cannot standardise {c}: no values")
        out[f"{c}{suffix}"] = (F.lit(0.0) if not s else (F.col(c) - F.lit(m)) / F.lit(s))
    return df.withColumns(out)


def scaler(inp: str, out: str, center: bool = True) -> StandardScaler:
    return StandardScaler(inputCol=inp, outputCol=out, withMean=center, withStd=True)


def label_ranks(df: DataFrame, column: str) -> DataFrame:
    """``(label, rank)`` of a column's non-null labels: the most frequent has rank 0,
    ties stand in alphabetical order.  Counted partially, then range-sorted
    and numbered by Spark: the labels never meet in one task or on the driver."""
    label = F.col(column).cast("string")
    counts = df.where(label.isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counts, [F.col("n").desc(), F.col("label")], "rank").select("label", "rank")


def string_index(df: DataFrame, column: str, out: str | None = None,
                 handle_invalid: str = "keep", fit_on: DataFrame | None = None,
                 max_labels: int | None = None) -> DataFrame:
    """Frequency-descending index (ties alphabetical), joined back to the rows;
    with ``keep``, values unseen at fit time and null both get index =
    number of labels, with ``skip`` their rows go and with ``error`` the query fails on them.

    Any number of labels: a table small enough is broadcast by the planner, a larger one is
    joined with hot labels dealt out (``salted_left_join``).  ``max_labels``:
    more of them are an error before anything is indexed."""
    out = out or f"{column}_idx"
    ranks = label_ranks(fit_on if fit_on is not None else df, column)
    n = ranks.agg(F.max("rank")).first()[0]
    n = 0 if n is None else int(n) + 1
    if max_labels is not None and n > max_labels:
        raise ValueError(f"{column} has {n} labels, more than {max_labels}")
    ranks = ranks.select(F.col("label").alias("__label"), F.col("rank").cast("double").alias("__rank"))
    rows = df.withColumn("__text", F.col(column).cast("string"))
    if broadcastable(ranks):
        j = rows.join(ranks, rows["__text"] == ranks["__label"], "left")
    else:
        j = salted_left_join(rows, ranks, ["__text"], ["__label"], [c for c, t in df.dtypes if t in SORTABLE])
    if handle_invalid == "keep":
        rank = F.coalesce("__rank", F.lit(float(n)))
    elif handle_invalid == "error":
        rank = F.coalesce("__rank", F.raise_error(F.concat(F.lit(f"unseen label in {column}: "), F.coalesce(
            "__text", F.lit("null")))).cast("double"))
    elif handle_invalid == "skip":
        j, rank = j.where(F.col("__rank").isNotNull()), F.col("__rank")
    else:
        raise ValueError(f"handle_invalid: {handle_invalid!r}")
    return j.withColumn(out, rank).drop("__text", "__label", "__rank")


#: Rows for one partition of a fit's layout, where the job names no number of partitions.
FIT_ROWS = 250_000


def layout_partitions(df: DataFrame, partitions: int | None = None) -> int:
    """Partition count for ``stable_layout``: a parameter of the job, or else by the number
    of rows, never read from the session: a cluster setting must not decide
    what a fit sees."""
    return int(partitions or max(8, -(-df.count() // FIT_ROWS)))


SORTABLE = ("int", "bigint", "double", "float", "string", "boolean", "date", "timestamp")


def stable_layout(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Hash-partition by a key into a fixed number of partitions and sort
    within them, by the key and then by all other sortable columns (the key
    may repeat, where a covariate fans out), so iterative fits see the same data
    layout whatever the input partitioning was, and give identical models.
    An explicit count is kept by AQE (it does not coalesce it)."""
    rest = [c for c, t in df.dtypes if c not in keys and t in SORTABLE]
    return df.repartition(layout_partitions(df, partitions), *keys).sortWithinPartitions(*keys, *rest)
