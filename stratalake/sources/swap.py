"""Replacing folders of a stored table in steps that may be repeated.

New content is written beside the table first. A manifest, which appears as a whole, then says which folders it replaces
and which are left without rows; only from there on are folders moved and deleted. Every step looks at what is there, so
a run that was killed is finished by the next one (`finish_replacement`), or dropped if it had no manifest yet.
Moving folders is metadata only: rows are written once. Readers should start after a replacement, not during it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.storage import located, path_exists, remove_folder, save_bucket_count, subfolders


def _move(spark: SparkSession, source: str, target: str) -> None:
    folder, files = located(spark, target)
    files.mkdirs(folder.getParent())
    if not files.rename(located(spark, source)[0], folder):
        raise OSError(f"cannot move {source} to {target}")


def folders_of(df: DataFrame, depth: int) -> list[str]:
    """The partition folders, `depth` levels deep, of a file scan's rows; "" for a table without partitions."""
    if depth == 0:
        return [""]
    found = df.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct().collect()
    uri = df.sparkSession._jvm.java.net.URI
    return sorted({"/".join(uri(r["folder"]).getPath().split("/")[-depth:]) for r in found})


def _filled(spark: SparkSession, root: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{name}".lstrip("/") for f in found for name in subfolders(spark, f"{root}/{f}")]
    return found


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    replaced: Iterable[str],
    bucket_count: int | None = None,
    tasks: int | None = None,
) -> None:
    """Put `df` in the place of the folders `replaced` (relative to `path`); those it has no rows for go.

    `bucket_count` is recorded with the table in the same step. Folders of even size can be dealt to a number of `tasks`;
    otherwise rows are rebalanced by their bytes, which leaves very many small folders to few tasks.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{path}-staged"
    finish_replacement(spark, path)
    placed = df
    if partition_by:
        placed = df.repartition(tasks, *partition_by) if tasks else df.hint("rebalance", *partition_by)
    writer = placed.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{staged}/data")
    filled = set(_filled(spark, f"{staged}/data", len(partition_by)))
    rows = [(f, f in filled, bucket_count) for f in sorted(filled | set(replaced))]
    manifest = spark.createDataFrame(rows, "folder string, filled boolean, buckets int").coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{staged}/manifest-new")
    _move(spark, f"{staged}/manifest-new", f"{staged}/manifest")
    finish_replacement(spark, path)


def finish_replacement(spark: SparkSession, path: str) -> bool:
    """Carry out what a replacement has staged completely; whether there was one. Every writer of a table begins with it."""
    path = path.rstrip("/")
    staged = f"{path}-staged"
    if not path_exists(spark, f"{staged}/manifest"):
        remove_folder(spark, staged)
        return False
    buckets = None
    for folder, filled, buckets in spark.read.parquet(f"{staged}/manifest").collect():
        swap_folder(spark, f"{staged}/data/{folder}".rstrip("/"), f"{path}/{folder}".rstrip("/"), filled)
    if buckets is not None:
        save_bucket_count(spark, path, buckets)
    remove_folder(spark, staged)
    return True


def swap_folder(spark: SparkSession, source: str, target: str, filled: bool) -> None:
    if not filled:
        remove_folder(spark, target)
    elif path_exists(spark, source):
        remove_folder(spark, target)
        _move(spark, source, target)
    elif not path_exists(spark, target):
        raise OSError(f"neither {source} nor {target} is there")
