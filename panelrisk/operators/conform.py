"""Row-level conforming operators: missing-value drops, slices, typed
projections, renames, safe casts, column discovery and stamping.  All are
narrow transformations (no shuffle) whose filters Catalyst pushes into the
scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import casts, text
from ..functions.lookup import translate


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop a row when *any* listed column is null or NaN."""
    return df.na.drop(how="any", subset=list(subset))


def slice_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Keep rows whose column equals a literal (e.g. one metric)."""
    return df.filter(F.col(column) == F.lit(value))


def filter_greater(df: DataFrame, column: str, threshold: float = 0) -> DataFrame:
    """Keep rows with ``column > threshold`` (null never passes)."""
    return df.filter(F.col(column) > F.lit(threshold))


def typed_projection(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Select the listed columns, each cast to its type (safe casts for
    numbers, plain casts otherwise)."""
    out = []
    for name, typ in spec.items():
        c = F.col(name)
        if typ in ("double", "float"):
            c = casts.safe_double(c)
        elif typ in ("int", "integer"):
            c = casts.safe_int(c)
        elif typ != "keep":
            c = c.cast(typ)
        out.append(c.alias(name))
    return df.select(*out)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored (as
    ``withColumnRenamed`` does)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def safe_casts(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast columns in place without ever raising under ANSI mode:
    unparsable values become null."""
    fns = {"double": casts.safe_double, "int": casts.safe_int, "integer": casts.safe_int}
    return df.withColumns({c: fns[t](c) if t in fns else F.col(c).try_cast(t)
                           for c, t in spec.items()})


def discover_column(columns: Sequence[str], needle: str, fallback: str = "error",
                    exclude: Sequence[str] = ()) -> str:
    """First column whose name contains ``needle`` (any case).  With no
    match: ``fallback="error"`` raises, ``"last"`` returns the last column.
    This inspects the schema only (driver metadata, no data is read)."""
    cols = [c for c in columns if c not in set(exclude)]
    for c in cols:
        if needle.lower() in c.lower():
            return c
    if fallback == "last" and columns:
        return columns[-1]
    raise ValueError(f"no column containing {needle!r} in {list(columns)}")


def conform_covariate(df: DataFrame, value_needle: str, value_name: str,
                      year_name: str, entity_src: str = "Entity", year_src: str = "Year",
                      entity_name: str = "country", fallback: str = "error",
                      positive_year: bool = False) -> DataFrame:
    """Covariate table -> ``(entity_name, year_name, value_name)``: discover
    the value column, rename, cast safely (ANSI-proof) and optionally drop
    non-positive years."""
    value_src = discover_column(df.columns, value_needle, fallback)
    out = df.select(F.col(entity_src).cast("string").alias(entity_name),
                    casts.safe_int(year_src).alias(year_name),
                    casts.safe_double(value_src).alias(value_name))
    if positive_year:
        out = out.filter(F.col(year_name) > 0)
    return out


def stamp_constants(df: DataFrame, values: Mapping[str, object],
                    copies: Mapping[str, str] | None = None) -> DataFrame:
    """Add literal columns (and column copies such as ``prediction := val``)."""
    cols: dict[str, Column] = {k: F.lit(v) for k, v in values.items()}
    for dst, src in (copies or {}).items():
        cols[dst] = F.col(src)
    return df.withColumns(cols)


def ensure_columns(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Add each missing column as a typed null; present columns are kept."""
    missing = {c: F.lit(None).cast(t) for c, t in spec.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def year_and_pattern(df: DataFrame, year: int, pattern: str = K.MAP_MEASURE_PATTERN,
                     year_col: str = K.YEAR, text_col: str = K.MEASURE) -> DataFrame:
    """``year == y`` AND case-insensitive regex match; null text is False."""
    return df.filter((F.col(year_col) == F.lit(year)) & text.contains_any(text_col, pattern))


def exclude_keywords(df: DataFrame, column: str, words: Sequence[str] = K.EXCLUDE_KEYWORDS,
                     literal: bool = False) -> DataFrame:
    """Drop rows whose text contains any keyword (substring, any case);
    null text is kept."""
    pat = text.keywords_pattern(words, literal=literal)
    return df.filter(~text.contains_any(column, pat))


def translate_column(df: DataFrame, column: str, mapping: Mapping[str, str],
                     out: str | None = None) -> DataFrame:
    """Dictionary translation with pass-through via a constant map literal
    (right for small, fixed dictionaries; see ``joins.dictionary_join``
    for dictionaries that are data)."""
    return df.withColumn(out or column, translate(column, mapping))


def standardise_names(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace whole values from a dictionary, *then* strip whitespace (a
    padded value therefore misses the dictionary)."""
    return df.withColumn(column, text.py_strip(translate(column, mapping)))


def entity_slice(df: DataFrame, entity: str, columns: Sequence[str],
                 entity_col: str = K.TRANSLATED, order_by: Sequence[str] = (K.YEAR,)) -> DataFrame:
    """Rows of one entity with the report columns, ordered."""
    return (df.filter(F.col(entity_col) == F.lit(entity))
              .select(*columns).orderBy(*order_by))
