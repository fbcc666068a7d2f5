"""Session-level helpers: shared scratch folder, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a broadcast side may have; ~100 bytes a row keeps it far below 1 GB.
BROADCAST_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="crawlloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several later steps read."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, rows: int | None = None
) -> DataFrame | None:
    """``df`` marked for broadcast, or None when it has more than ``max_rows`` rows.

    Without ``rows`` they are counted, so pass something cheap to read.
    """
    if (df.count() if rows is None else rows) > max_rows:
        return None
    return F.broadcast(df)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_keys(df: DataFrame, keys) -> DataFrame:
    """Shuffle by ``keys`` into the configured number of partitions.

    A stated number keeps adaptive execution from merging partitions that are
    small in bytes but long in computing.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), *keys)


# Input below this size per core may be dealt out again; Spark reads more in one split.
SPREAD_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input out over all cores.

    A file with a single row group is read by one task, however many cores are
    free. The shuffle is taken only while Spark's size estimate stays below
    ``SPREAD_BYTES`` per core; larger input has enough splits and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if estimate < cores * SPREAD_BYTES else df
