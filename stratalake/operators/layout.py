"""File layout jobs: compaction, multi-column clustering, and what a filter has to touch."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.swap import finish_replacement, replace_partitions

DEFAULT_FILE_BYTES = 256 * 1024 * 1024
#: Rows that a task of the clustering sorts in memory.
MAX_ROWS_PER_SORT = 1_000_000


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = DEFAULT_FILE_BYTES,
    partition_by: Sequence[str] = (),
) -> None:
    """Rewrite many small Parquet files as few of about `target_bytes`.

    The scan itself packs small files into tasks of the wanted size, so nothing
    is shuffled. A partitioned table is rebalanced by its partition columns
    instead, where AQE joins small pieces and splits a large one.
    """
    tuned = _packing_session(spark, target_bytes)
    df = tuned.read.parquet(source)
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)


def _packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    tuned = spark.newSession()  # same context, own settings: the caller's session is left alone
    tuned.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    tuned.conf.set("spark.sql.files.minPartitionNum", "1")
    tuned.conf.set("spark.sql.files.openCostInBytes", "0")
    tuned.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    # Partition values stay the text of their folder, so that 01 is not written back as 1.
    tuned.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return tuned


def folder_files(spark: SparkSession, path: str, depth: int, target_bytes: int = DEFAULT_FILE_BYTES) -> DataFrame:
    """(folder, files, bytes, small) per partition folder of a stored table, `depth` levels deep ("" without partitions).

    `small` counts files below half of `target_bytes`. Names and lengths come from the file listing; no file is opened.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    parts = F.split("path", "/")
    files = listing.load(path).select(F.array_join(F.slice(parts, -1 - depth, depth), "/").alias("folder"), "length")
    return files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.count_if(F.col("length") < target_bytes / 2).alias("small"),
    )


def compact_in_place(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), target_bytes: int = DEFAULT_FILE_BYTES
) -> list[str]:
    """Compact those partitions of a stored table that have at least two small files; the folders rewritten.

    The other partitions are neither read nor moved. Folders are replaced in steps that the next writer finishes if this
    run is killed; readers should start afterwards. The names of touched folders pass through the driver.
    """
    finish_replacement(spark, path)
    crowded = folder_files(spark, path, len(partition_by), target_bytes).filter("small >= 2").select("folder")
    folders = sorted(r["folder"] for r in crowded.collect())
    if folders:
        tuned = _packing_session(spark, target_bytes)
        root = path.rstrip("/")
        rows = tuned.read.option("basePath", root).parquet(*[f"{root}/{f}".rstrip("/") for f in folders])
        replace_partitions(rows, root, partition_by, folders)
    return folders


def _cut_points(df: DataFrame, columns: Sequence[str], pieces: int, sample_rows: int) -> dict[str, list]:
    """Quantiles per column from a uniform sample of bounded size, for any orderable type."""
    sample = (
        df.select(*columns, F.rand(7).alias("_r")).orderBy("_r").limit(sample_rows).drop("_r").collect()
    )
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        marks = [values[len(values) * i // pieces] for i in range(1, pieces)] if values else []
        cuts[c] = sorted(set(marks))
    return cuts


def _marks_up_to(value: Column, marks: list, base: int = 0) -> Column:
    """How many of the sorted marks are <= value, by halving."""
    if not marks:
        return F.lit(base)
    middle = len(marks) // 2
    return F.when(
        value >= F.lit(marks[middle]), _marks_up_to(value, marks[middle + 1 :], base + middle + 1)
    ).otherwise(_marks_up_to(value, marks[:middle], base))


def z_value(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of several numbers, interleaved."""
    z = F.lit(0).cast("bigint")
    for i, number in enumerate(numbers):
        for b in range(bits):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(bit, b * len(numbers) + i))
    return z


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    files: int,
    bits: int | None = None,
    sample_rows: int | None = None,
    max_rows_per_sort: int = MAX_ROWS_PER_SORT,
) -> DataFrame:
    """Cluster rows so that files have a narrow range in each of `columns`.

    Columns are replaced by their quantile number for the purpose. There are 2**bits quantiles a column, by default four
    times as many as the files need if each column has its share of them (16 at least, 1024 at most), estimated from
    64 sampled rows for each. The row id as
    the last range key lets equal rows, however many, be spread over several
    files. Give it a stored table: the order of a file scan makes row ids
    repeatable. Write the result as it is, one file per partition.

    A task sorts about `max_rows_per_sort` rows. Larger files are put together from sorted runs, each of a range of its own
    and in one piece, which costs a second shuffle; the runs of a file may come in any order.
    """
    if bits is None:
        bits = min(max(4, math.ceil(math.log2(max(files, 1)) / len(columns)) + 2), 10, 62 // len(columns))
    cuts = _cut_points(df, columns, 2**bits, sample_rows or max(4000, 64 * 2**bits))
    numbers = {f"_q{i}": _marks_up_to(F.col(c), cuts[c]) for i, c in enumerate(columns)}
    # In a projection of their own, the numbers are computed once and not once per bit.
    placed = df.withColumns(numbers).withColumns(
        {"_z": z_value([F.col(q) for q in numbers], bits), "_row": F.monotonically_increasing_id()}
    )
    runs = -(-df.count() // (files * max_rows_per_sort)) or 1
    ranged = placed.drop(*numbers).repartitionByRange(files * runs, "_z", "_row").sortWithinPartitions("_z", *columns)
    if runs > 1:
        ranged = ranged.withColumn("_file", F.floor(F.spark_partition_id() / runs).cast("int"))
        ranged = ranged.repartitionById(files, "_file").drop("_file")
    return ranged.drop("_z", "_row")


def table_detail(df: DataFrame) -> DataFrame:
    """One row: number of files and bytes of a file scan."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).distinct()
    return files.agg(
        F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_in_bytes")
    )


def files_touched(df: DataFrame, column: str, value: object) -> DataFrame:
    """One row: files in all, and files whose value range can hold `value`."""
    ranges = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )
    hit = F.lit(value).between(F.col("low"), F.col("high"))
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(hit).alias("touched"))
