"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder the cluster names.

    Only a session on one machine may go without; then a temporary one is made.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="stratalake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to a work folder and return the scan of it."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_version(df: DataFrame, root: str, version: int) -> None:
    """Write one state of a small control table. A replay rewrites the same folder."""
    df.write.mode("overwrite").parquet(f"{root}/_version={version}")


def load_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The named or the newest state written by `save_version`; None where there is none."""
    try:
        states = spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if version is None:
        version = states.agg(F.max("_version")).first()[0]
        if version is None:
            return None
    return states.filter(F.col("_version") == version).drop("_version")


@functools.lru_cache(maxsize=1)
def _path_class(jvm):
    # Each step of such a name is a call to the JVM, too many where thousands of folders are moved.
    return jvm.org.apache.hadoop.fs.Path


def located(spark: SparkSession, path: str):
    """The path and its store, as objects of the JVM."""
    folder = _path_class(spark._jvm)(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names; nothing happens where there is none."""
    folder, files = located(spark, path)
    files.delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = located(spark, path)
    return files.exists(folder)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder that hold data (`name=value`); none if it is missing."""
    if not path_exists(spark, path):
        return []
    folder, files = located(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory()]
    return sorted(n for n in names if "=" in n)


def save_bucket_count(spark: SparkSession, table: str, count: int) -> None:
    """Record the number of buckets; the first one recorded stays known."""
    root = f"{table.rstrip('/')}-buckets"
    version = 0 if load_version(spark, root, 0) is None else count
    save_version(spark.range(1).select(F.lit(count).alias("buckets")), root, version)


def saved_bucket_counts(spark: SparkSession, table: str) -> tuple[int, int] | None:
    """(buckets at the beginning, buckets now) of a table."""
    root = f"{table.rstrip('/')}-buckets"
    first = load_version(spark, root, 0)
    return None if first is None else (first.first()["buckets"], load_version(spark, root).first()["buckets"])


def fixed_buckets(spark: SparkSession, table: str, buckets: int | None, default: int = 64) -> int:
    """The bucket count a table was begun with, kept beside it; the first call settles it, another count is refused.

    A table that has folders but no count must be told it: a guess would look for keys in the wrong folders.
    """
    known = saved_bucket_counts(spark, table)
    if known is None:
        if buckets is None and subfolders(spark, table):
            raise ValueError(f"{table} has folders but no bucket count; name the one it was written with")
        save_bucket_count(spark, table, buckets or default)
        return buckets or default
    if buckets not in (None, known[0]):
        raise ValueError(f"{table} has {known[0]} buckets, not {buckets}")
    return known[0]


def save_progress(spark: SparkSession, root: str, pipeline: str, source: str, last_version: int) -> None:
    """Record how far a pipeline has read its source; call it after the data is written.

    A crash in between replays the same versions, which is safe because changes
    are applied by key.
    """
    row = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(source).alias("source_table"),
        F.lit(last_version).cast("bigint").alias("last_version"),
        F.current_timestamp().alias("updated_at"),
    )
    row.write.mode("append").parquet(root)


def read_progress(spark: SparkSession, root: str, pipeline: str, default: int = 0) -> int:
    """The version the pipeline processed last; `default` before the first run."""
    try:
        log = spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return default
        raise
    newest = log.filter(F.col("pipeline_name") == pipeline).agg(
        F.max_by("last_version", F.struct("updated_at", "last_version"))
    )
    found = newest.first()[0]
    return default if found is None else found
