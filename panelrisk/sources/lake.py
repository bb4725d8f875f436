"""Lake zones (raw, curated) and result sinks.  Paths live in the shared
folder of the cluster (see ``session.shared_path``); lost tasks are tried
again by Spark, and a job that fails is run again as a whole.

A *zone* is overwritten at once: ``publish`` writes a new version folder beside the
ones that stand and then moves one pointer file, and ``read_zone`` reads the version that the
pointer names.  A write that fails, or is still running, leaves readers with the version
before.  Exports and reports (``land``) are plain folders for other
programs: there the old files go before the new ones."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators.conform import safe_casts


def land(df: DataFrame, path: str, fmt: str = "parquet",
         partition_by: Sequence[str] | None = None, rebalance: bool = True) -> str:
    """Overwrite ``path`` with ``df`` (``fmt``: parquet or csv with header).

    A partitioned write is preceded by a ``rebalance`` on the partition
    columns: without it every task writes one file per partition value it
    holds (tasks x years small files at scale).  AQE then sizes the write
    tasks to the advisory partition size, splitting a hot year into several
    tasks and merging small ones."""
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)
    return path


#: Pointer file of a zone.
POINTER = "_current"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def resolve(spark: SparkSession, path: str) -> str:
    """The folder that holds a zone's rows: the version its pointer names, or
    ``path`` itself where there is no pointer (a plain folder)."""
    pointer, fs = _file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    if any(c in path for c in "*?[{") or not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> str:
    """Overwrite a zone: a new version is written whole, then the pointer moves
    to it (a rename, which replaces the old pointer in one step).  The version that the pointer
    named before stays, for readers that have begun; what is older than that goes,
    the remains of writes that failed included.  ``df`` may read the zone itself."""
    spark, root = df.sparkSession, path.rstrip("/")
    before = resolve(spark, root).rsplit("/", 1)[-1]
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    land(df, f"{root}/{version}", fmt, partition_by)
    jvm = spark._jvm
    fresh, fs = _file_system(spark, f"{root}/{POINTER}-{version}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    replace[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(pointer), replace)
    for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(root)):
        name = f.getPath().getName()
        if name.startswith("v-") and before.startswith("v-") and name < before:
            fs.delete(f.getPath(), True)
    return path


def read_zone(spark: SparkSession, path: str, fmt: str = "parquet",
              casts: Mapping[str, str] | None = None, schema=None) -> DataFrame:
    """Re-read a zone (or a plain folder); ``casts`` are applied safely (never raise)."""
    path = resolve(spark, path)
    if fmt == "csv":
        r = spark.read.option("header", "true")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
        df = r.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return safe_casts(df, casts) if casts else df


def roundtrip(df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: Sequence[str] | None = None,
              casts: Mapping[str, str] | None = None, schema=None) -> DataFrame:
    """Publish a zone, then re-read it: the re-read plan starts at the files, which cuts
    the lineage (a lost executor recomputes from the zone, not the source)."""
    publish(df, path, fmt, partition_by)
    out = read_zone(df.sparkSession, path, fmt, casts, schema)
    if partition_by and fmt != "csv":
        out = out.select(*df.columns)
    return out


def export_csv(df: DataFrame, path: str, columns: Sequence[str] = K.EXPORT_COLUMNS) -> str:
    """Named columns to CSV files with a header, written by the executors
    (no ``toPandas``: nothing passes through the driver)."""
    return land(df.select(*columns), path, "csv")


def metrics_row(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column of a (one-row) report."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def write_metrics(df: DataFrame, path: str, digits: int = 4) -> str:
    """Write a one-row metrics report (header + row) as a single CSV file."""
    return land(metrics_row(df, digits).coalesce(1), path, "csv")
