"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest table, in bytes, that a join here will broadcast by itself. A block row
# stands for a whole file split, so this covers some 30 TB of text in 128 MB
# splits; above it the same join shuffles.
BROADCAST_LIMIT = 128 * 1024 * 1024


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the operators expect; cluster sizing stays with the caller."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    such a folder would exist on one machine only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(context.applicationId)


@cache
def _local_folder(application: str) -> str:
    """One temporary folder per local-mode application."""
    return tempfile.mkdtemp(prefix="feedmill-")


# Folders handed out, by application, until they are cleaned up.
_handed_out: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, until :func:`clean_up`."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean_up(spark: SparkSession) -> int:
    """Delete every folder this process has handed out in this application; returns how many.

    Block tables, stored steps and feeds in the shared folder are needed as long as a
    frame that starts from them is; call this when the results are written.
    """
    context = spark.sparkContext
    paths = _handed_out.pop(context.applicationId, [])
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


def pin_scan_splits(spark: SparkSession) -> None:
    """Keep the file splits of repeated scans equal while executors come and go.

    Spark derives the split size from the number of cores known at planning
    time; fixing the minimum partition number takes that input out.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Store ``df`` as a table in the shared folder and continue from the copy.

    One pass computes it, whatever uses it later starts from the stored rows, and
    a lost executor loses none of them.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder and continue from there.

    Like :func:`cut`, one pass computes it; its rows also keep their order and their tasks,
    which a table that is read again does not.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured size is within the limit."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_LIMIT else df
