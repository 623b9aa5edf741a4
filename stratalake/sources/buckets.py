"""Tables in folders by key bucket that grow one bucket at a time.

A table begins with a few buckets. As it grows, buckets are split in turn (linear hashing): bucket b of the first n
passes part of its keys to bucket n + b and no other folder is touched. How many there are is kept beside the
table and changes in the same replacement that moves the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.storage import fixed_buckets, saved_bucket_counts
from stratalake.sources.swap import replace_partitions

BUCKET = "_bucket"
FIRST_BUCKETS = 16
#: A table splits buckets once they hold more rows than this on average.
ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Buckets:
    """`first` buckets at the beginning, `count` now."""

    first: int
    count: int

    def of(self, keys: Sequence[str]) -> Column:
        """The bucket of a row."""
        size = self.first
        while 2 * size <= self.count:
            size *= 2
        h = F.xxhash64(*keys)
        wide = F.pmod(h, F.lit(2 * size))
        return F.when(wide < self.count, wide).otherwise(F.pmod(h, F.lit(size))).cast("int")

    def origin(self, bucket: int, count: int) -> int:
        """Which bucket the keys of `bucket` were in when there were only `count`."""
        while bucket >= count:
            size = self.first
            while 2 * size <= bucket:
                size *= 2
            bucket -= size
        return bucket


def open_buckets(spark: SparkSession, table: str, first: int | None = None) -> Buckets:
    """The buckets of a table; a new one begins with `first`. A table with folders must know its buckets or be told."""
    begun = fixed_buckets(spark, table, first, FIRST_BUCKETS)
    return Buckets(begun, saved_bucket_counts(spark, table)[1])


def read_buckets(spark: SparkSession, table: str, only: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of some or all buckets; None before the first write."""
    try:
        rows = spark.read.parquet(table)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows if only is None else rows.filter(F.col(BUCKET).isin(list(only)))


def write_buckets(df: DataFrame, table: str, touched: Sequence[int]) -> None:
    """Replace the buckets `touched` by `df`, which has their number in `_bucket`."""
    replace_partitions(df, table, [BUCKET], [f"{BUCKET}={b}" for b in touched], tasks=_tasks(df, len(touched)))


def _tasks(df: DataFrame, buckets: int) -> int | None:
    """Tasks to write so many buckets with; None for few, of which a large one may take several tasks."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return most if buckets >= 4 * most else None


def grow(
    spark: SparkSession, table: str, keys: Sequence[str], sample: Sequence[int], rows_per_bucket: int = ROWS_PER_BUCKET
) -> Buckets:
    """Split buckets until they hold `rows_per_bucket` rows on average, judged by the buckets `sample`.

    Only the row counts of the sampled buckets are looked at (they are in the file footers), and only buckets that
    lose keys are rewritten.
    """
    begun, count = saved_bucket_counts(spark, table)
    now = Buckets(begun, count)
    held = read_buckets(spark, table) if sample else None  # the folders are listed once
    rows = held.filter(F.col(BUCKET).isin(list(sample))).count() if held else 0
    wanted = -(-rows * count // (max(1, len(sample)) * rows_per_bucket))
    if wanted <= count:
        return now
    after = Buckets(begun, wanted)
    split = sorted({after.origin(b, count) for b in range(count, wanted)})
    moved = held.filter(F.col(BUCKET).isin(split)).withColumn(BUCKET, after.of(keys))
    tasks = _tasks(moved, wanted - count)
    replace_partitions(moved, table, [BUCKET], [f"{BUCKET}={b}" for b in split], bucket_count=wanted, tasks=tasks)
    return after
