"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every chirp job relies on. Time parts are read from text that
# says +0000, so the session clock must be UTC for parsed and formatted
# timestamps to agree (see clean_tweets).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "chirp",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with chirp's base settings.

    On a cluster, leave ``master`` unset and size ``shuffle_partitions``
    to the data (roughly input bytes / 128 MB); locally it defaults to
    the core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset, a local folder is chosen for local masters only (tests,
    laptops); on a cluster that raises, since executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local[") and master != "local":
            raise RuntimeError(f"spark.checkpoint.dir is not set; master {master} needs a shared folder there")
        root = os.path.join("/tmp", f"chirp-checkpoints-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/chirp/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the application's scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clean_scratch(spark: SparkSession) -> bool:
    """Deletes all scratch files of this application. Call it when no result
    that reads them is needed any more (results are lazy)."""
    return delete_path(spark, scratch_root(spark))


def delete_path(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """``df`` written to the scratch folder and read back: cuts the lineage,
    so later passes and lost executors re-read files. ``schema`` names the
    types to read where they are not the written ones (a struct as the user
    type it is the storage of)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def folder_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Name and bytes of each folder that lies in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName(): fs.getContentSummary(f.getPath()).getLength() for f in fs.listStatus(p) if f.isDirectory()}


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Inside the block, an execution's shuffle files are deleted when it has
    ended instead of when the driver's JVM next collects garbage. For writes
    whose frame is not used again."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def open_writers(spark: SparkSession, n: int):
    """Inside the block, a task of a partitioned write keeps up to ``n`` files
    open instead of sorting (and spilling) its whole rows by folder; rows of
    further folders are sorted."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(n))


@contextmanager
def staged(df: DataFrame, name: str, partition_by: list[str], writers: int):
    """``df`` stored for the time of the block, well compressed, and the path:
    for rows that several passes need and that are too large to persist, as
    blocks on the executors' disks are not compressed. Each value of
    ``partition_by`` has a folder, whose files are written side by side, in
    small row groups and pages, as a writer holds one of each in memory."""
    path = scratch_path(df.sparkSession, name)
    try:
        with open_writers(df.sparkSession, writers):
            (df.write.option("compression", "zstd").option("parquet.block.size", str(4 << 20)).option("parquet.page.size", str(256 << 10))
             .partitionBy(*partition_by).parquet(path))
        yield df.sparkSession.read.schema(df.schema).parquet(path), path
    finally:
        delete_path(df.sparkSession, path)
