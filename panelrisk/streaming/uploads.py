"""Newly uploaded files, classified as they arrive.

The original classifies one uploaded file in a batch script.  Here the
upload folder is a Structured Streaming file source: each micro-batch takes
the new files (the file is part of the lookup's key, so "first matching row"
keeps its per-file meaning), runs the same C4 classification on them, and
writes the result under ``batch_id=<n>`` with overwrite.  A retried batch rewrites its
own folder, so the sink is exactly-once together with the checkpoint, which
lives in the shared checkpoint folder.

An upload of many files is a folder.  Its files may arrive in any number of
micro-batches, so it is announced by one small file once all of them stand; the stream
follows the announcements and reads each announced folder whole.  "First" then means
the order of the file names, and the place within a file.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import constants as K
from ..plans import jobs
from ..session import shared_path
from ..sources import lake
from ..sources.csv import row_in_block

UPLOAD_SCHEMA = "location_name string, metric_name string, val double"


def start_upload_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                        checkpoint: str | None = None, schema: str = UPLOAD_SCHEMA,
                        available_now: bool = True, files_per_batch: int | None = None, dictionary: Mapping[str, str] | DataFrame
                        = K.MAP_STAGE_NAMES, **classify_kw) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops
    (a scheduled job), otherwise it keeps polling for new files.
    ``files_per_batch`` bounds a micro-batch; it does not change the rows."""
    reader = spark.readStream.schema(schema).option("header", "true")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = (reader.csv(source_dir).withColumn("source_file", F.col("_metadata.file_path"))
              .withColumn("_block", F.col("_metadata.file_block_start")))

    def classify_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(K.SEQ, row_in_block(F.col("_block"))).drop("_block")
        out = jobs.classify_upload(rows, dictionary=dictionary, upload_column="source_file", **classify_kw)
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    writer = (stream.writeStream.foreachBatch(classify_batch)
              .option("checkpointLocation", checkpoint or shared_path(spark, "streams", "uploads")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


ANNOUNCED, FILES = "announced", "files"


def upload_of(file: str) -> Column:
    """Name of the upload (the folder) that a file path belongs to.  The path is cut at its last
    slashes: this runs on every row."""
    return F.substring_index(F.substring_index(file, "/", -2), "/", 1)


def announce_upload(df: DataFrame, inbox: str, name: str) -> str:
    """Land ``df`` as the upload ``name`` (CSV files in the order of its partitions, written by the
    executors), then announce it.  The announcement appears in one step, by a rename."""
    spark, root = df.sparkSession, inbox.rstrip("/")
    path = lake.land(df, f"{root}/{FILES}/{name}", "csv")
    hadoop = spark._jvm.org.apache.hadoop.fs
    hidden, shown = hadoop.Path(f"{root}/{ANNOUNCED}/_{name}"), hadoop.Path(f"{root}/{ANNOUNCED}/{name}")
    fs = shown.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, shown):
        raise FileExistsError(f"an upload named {name} is announced already")
    return path


def start_announced_stream(spark: SparkSession, inbox: str, sink_dir: str, checkpoint: str | None = None,
                           schema: str = UPLOAD_SCHEMA, available_now: bool = True,
                           uploads_per_batch: int | None = None,
                           dictionary: Mapping[str, str] | DataFrame = K.MAP_STAGE_NAMES,
                           **classify_kw) -> StreamingQuery:
    """Classify announced uploads; a micro-batch holds whole uploads only, at most
    ``uploads_per_batch`` of them.  Of a batch the driver sees the uploads' names."""
    root = inbox.rstrip("/")
    reader = spark.readStream.option("wholetext", "true")
    if uploads_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", uploads_per_batch)

    def classify_batch(batch: DataFrame, batch_id: int) -> None:
        names = sorted(r["value"] for r in batch.collect())
        if not names:
            return
        session = batch.sparkSession
        rows = (session.read.schema(schema).option("header", "true").csv([f"{root}/{FILES}/{n}" for n in names])
                .withColumn("source_file", F.col("_metadata.file_path")).withColumn(K.SEQ, row_in_block()))
        rows = rows.withColumn("upload", upload_of("source_file"))
        out = jobs.classify_upload(rows, dictionary=dictionary, upload_column="upload",
                                   order=["source_file", K.SEQ], **classify_kw)
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    writer = (reader.text(f"{root}/{ANNOUNCED}").writeStream.foreachBatch(classify_batch)
              .option("checkpointLocation", checkpoint or shared_path(spark, "streams", "announced")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_classified(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Everything the stream has classified so far (``batch_id`` included)."""
    return spark.read.parquet(sink_dir)
