"""Session helpers: a tuned local session for tests/bench, and the shared
folder used for lake zones and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: Folder made for a local session without ``spark.checkpoint.dir``, by application id.
_LOCAL_DIRS: dict[str, str] = {}

# Settings that matter at scale; all are plain public Spark configuration.
SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # ones, and turn a sort-merge join into a broadcast join only when the
    # measured side is below the (checked) threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Explicit ceiling for planner-chosen broadcasts (bytes, size-checked).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "panelrisk", **conf: str) -> SparkSession:
    """Local session for tests and the bench (cluster jobs bring their own).
    ``conf``: further settings, dots written as double underscores."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("PANELRISK_DRIVER_MEMORY", "8g")))
    for k, v in (SCALE_CONF | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset a
    local master gets a private folder (tests, laptops); any other master is
    refused, because a folder of the driver's own disk is not shared.  The
    RDD checkpoint directory (``DataFrame.checkpoint``) is pointed there once."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(sc.applicationId)
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="panelrisk-ckpt-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path inside the shared checkpoint folder (never a machine-local
    temp dir on a cluster).  ``unique`` appends a fresh id so concurrent or
    repeated runs never collide."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = "/".join(p.strip("/") for p in parts)
    if unique:
        tail = f"{tail}/{uuid.uuid4().hex}" if tail else uuid.uuid4().hex
        if _OWNED:
            _OWNED[-1].append(f"{base}/{tail}")
    return f"{base}/{tail}"


def staged(df: DataFrame, *parts: str) -> DataFrame:
    """Write a step's rows into a new work folder (see ``shared_path``) and go on from the files: a
    durable cut of the lineage, read back without listing a schema."""
    path = shared_path(df.sparkSession, *parts)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept by the executors, for a summary that several later steps read: its
    size is then known when they are planned.  It goes with the run that owns the work folders, if any."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    if _HELD:
        _HELD[-1].append(df)
    return df


#: Work folders and held frames of the runs that are open, the innermost last.
_OWNED: list[list[str]] = []
_HELD: list[list[DataFrame]] = []


@contextmanager
def owned_work(spark: SparkSession) -> Iterator[list[str]]:
    """A run that owns its work folders: those that ``shared_path`` names inside go
    when the run ends, also when it fails, and so do the frames that are ``held``.

    Frames made inside read those folders, so land the result (in a path of
    your own) before the run ends.  Without an owner folders stay until
    the cluster clears its checkpoint folder."""
    mine: list[str] = []
    frames: list[DataFrame] = []
    _OWNED.append(mine)
    _HELD.append(frames)
    try:
        yield mine
    finally:
        _OWNED[:] = [x for x in _OWNED if x is not mine]
        _HELD[:] = [x for x in _HELD if x is not frames]
        for df in frames:
            df.unpersist()
        for path in mine:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
