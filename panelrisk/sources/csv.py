"""CSV sources: multi-file scans with a declared schema and a null-token
normaliser for files written by pandas-like tools."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import constants as K
from ..functions.casts import safe_double, safe_int
from ..operators.joins import broadcastable, salted_left_join
from ..operators.ranks import numbered

# FIXED VALUES: the text tokens pandas reads as missing by default.
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null"]


def _reader(spark: SparkSession, schema: StructType | str | None, header: bool, infer: bool):
    r = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if schema is not None:
        return r.schema(schema)
    return r.option("inferSchema", "true") if infer else r


def read_csv_files(spark: SparkSession, paths: str | Sequence[str],
                   schema: StructType | str | None = None, header: bool = True,
                   with_seq: bool = False, infer: bool = True) -> DataFrame:
    """All files matching ``paths`` (globs allowed) as one table.

    A declared ``schema`` avoids the extra inference job per source
    (``infer=False`` without a schema reads every column as text).  No
    matching file raises ``FileNotFoundError`` before any job runs.  With
    ``with_seq`` a ``seq`` column records input order: the file path, then
    the position in the scan (for keep-first semantics)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no input files given")
    try:
        df = _reader(spark, schema, header, infer).csv(paths)
    except AnalysisException as e:  # PATH_NOT_FOUND for an empty glob
        raise FileNotFoundError(f"no input files match {paths}: {e}") from None
    return with_input_order(df, paths=paths) if with_seq else df


def row_in_block(block: Column | None = None) -> Column:
    """Place of a text row in its file: start of the block (a column of the
    scan, unless carried along as ``block``) + row in the task.  A block is read by one task and has fewer rows than bytes, so places rise
    within a file."""
    low = (1 << 33) - 1  # rows of a task, in the lower bits of the id
    start = F.col("_metadata.file_block_start") if block is None else block
    return start + F.monotonically_increasing_id().bitwiseAND(F.lit(low))


def listed_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(file)``: the files that a scan of ``paths`` reads, as data.  Spark lists them (in
    parallel where there are many); no content is read."""
    return spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_path").alias("file"))


def with_input_order(df: DataFrame, place: Column | None = None, paths: Sequence[str] | None = None) -> DataFrame:
    """Add ``source_file`` and ``seq``: the order of the files' paths, then the
    place in the file, whatever order the scan reads the files in.

    ``seq`` holds the path's rank above 40 bits of ``place`` (by default
    ``row_in_block``; Parquet files number their rows themselves).  The ranks are
    data: the files (listed from ``paths``, or else those that rows come from) are numbered
    by Spark and joined back; no list of names meets on the driver, and rows of a file that holds
    most of them are dealt out where the names are too many to broadcast."""
    placed = (df.withColumn("source_file", F.col("_metadata.file_path"))
                .withColumn(K.SEQ, row_in_block() if place is None else place))
    files = (listed_files(df.sparkSession, paths) if paths else
             placed.select(F.col("source_file").alias("file"))).distinct()
    # by the names as they are, not as they are escaped (a plus sign is no blank)
    ranks = numbered(files, [F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))], "_rank")
    if broadcastable(ranks):
        met = placed.join(ranks, placed["source_file"] == ranks["file"], "left")
    else:
        met = salted_left_join(placed, ranks, ["source_file"], ["file"], [K.SEQ])
    unlisted = F.raise_error(F.concat(F.lit("file not listed: "), "source_file")).cast("long")
    return (met.withColumn(K.SEQ, F.shiftleft(F.coalesce("_rank", unlisted), 40) + F.col(K.SEQ))
            .drop("_rank", "file"))


def normalise_null_tokens(df: DataFrame, columns: Sequence[str] | None = None,
                          tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Text columns: any missing-value token -> null."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None).cast("string"))
                                .otherwise(F.col(c)) for c in cols})


def read_csv_null_tokens(spark: SparkSession, paths: str | Sequence[str],
                         types: Mapping[str, str], header: bool = True,
                         tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Read every column as text, turn missing-value tokens into null, then
    cast safely to ``types`` (``double``/``int``/``string``)."""
    schema = StructType([StructField(c, StringType(), True) for c in types])
    df = normalise_null_tokens(read_csv_files(spark, paths, schema, header), list(types), tokens)
    cast = {"double": safe_double, "int": safe_int, "integer": safe_int}
    return df.select(*[(cast[t](c) if t in cast else F.col(c).cast(t)).alias(c)
                       for c, t in types.items()])
