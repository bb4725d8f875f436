"""Helpers shared by the operators: staging, distributed ranks, salted joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelrisk.session import shared_path

#: The white space of the text contracts: blank and tab to carriage return.
WHITE = " \t\n\x0b\f\r"

#: Slices that a hot group is dealt into by the salted joins.
SALTS = 32

_STAGED: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    path = shared_path(spark, "llm", name)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it again.

    This cuts the lineage: a lost executor costs a re-read of files, and what
    is read twice is computed once."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the staged folders of this application, once results are landed."""
    jvm = spark.sparkContext._jvm
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def salt(by: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, null being equal to null; the right side's keys go."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_group_totals(rows: DataFrame, keys: Sequence[str], id_col: str, partial: dict[str, Column],
                      final: dict[str, Column], salts: int = SALTS) -> DataFrame:
    """Give every row the aggregates of its group, also where one group holds
    a third of all rows.

    Groups are first summed by (keys, slice), a slice being a hash of the
    row's id; only those sums meet by key, at most ``salts`` rows for each,
    and go back to the rows by (keys, slice).  ``partial`` aggregates rows,
    ``final`` aggregates the partial columns by name.  Null keys are equal."""
    salted = rows.withColumn("_salt", salt(F.col(id_col), salts))
    slices = salted.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in partial.items()])
    totals = slices.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()])
    back = null_safe_join(slices.select(*keys, "_salt"), totals, keys, "inner")
    return null_safe_join(salted, back, [*keys, "_salt"]).drop("_salt")


def with_small_table(rows: DataFrame, small: DataFrame, keys: Sequence[str], id_col: str,
                     salts: int = SALTS) -> DataFrame:
    """Left join to a table with one row for each key (null-safe).  The table
    is repeated for each slice and the rows are dealt out by a hash of their
    id, so that a key that holds a third of all rows is spread as well."""
    dealt = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("_salt", salt(F.col(id_col), salts))
    return null_safe_join(salted, dealt, [*keys, "_salt"]).drop("_salt")


def ranked(df: DataFrame, by: Sequence[Column], name: str, rank: str = "rank") -> DataFrame:
    """Rows with their place (0, 1, ...) in the order of ``by`` over the whole
    frame.

    The frame is range-partitioned and sorted, each row takes its place in
    its partition, and the partitions' row counts give the offsets.  The only
    thing that meets in one task, and is broadcast, is one row for each
    partition.  The sorted frame is staged, so places cannot change between
    reads.  Where rows tie on all of ``by`` their order is arbitrary but
    fixed."""
    row, low = F.monotonically_increasing_id(), 33  # Spark: partition in the upper bits, row in the lower 33
    placed = stage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", row), name)
    placed = (placed.withColumn("_part", F.shiftright("_row", low))
              .withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << low) - 1))))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(before), "_part", "left")
            .withColumn(rank, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before"))


def map_texts(src: DataFrame, make: Callable[[], Callable[[list], dict]], adds: dict[str, str]) -> DataFrame:
    """The columns of ``src`` but ``text``, untouched, and the columns in
    ``adds`` (name to SQL type) that the function from ``make`` gives for a
    batch of texts.  ``make`` runs once in each task."""
    kept = [f for f in src.schema.fields if f.name != "text"]
    types = {"double": pa.float64(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(),
             "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            found = work(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in kept] + [pa.array(found[n], types[t]) for n, t in adds.items()],
                names=[f.name for f in kept] + list(adds))

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{n} {t}" for n, t in adds.items()]
    return src.mapInArrow(run, ", ".join(schema))


def semi_join_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``; a null id matches a null id.
    Rows of ``docs`` are never multiplied."""
    wanted = ids.select(F.col(id_col).alias("_wanted_id"))
    return docs.join(wanted, docs[id_col].eqNullSafe(wanted["_wanted_id"]), "left_semi")
