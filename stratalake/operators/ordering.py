"""Ordered work per key that stays distributed when one key is huge, and balanced buckets.

A window over a key puts all rows of that key into one task. Where a key has more
rows than a task should sort, rows are range-partitioned by (key, order) instead,
so that a key spans as many tasks as it needs, and only the chunk ends are stitched.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.storage import cut_lineage, stored

# Rows of one key that a single task may sort (it spills beyond memory).
MAX_ROWS_PER_KEY = 20_000_000


def has_hot_key(df: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_ROWS_PER_KEY) -> bool:
    """Whether some key has more than `max_rows` rows. Reads only the keys; None skips the check."""
    if max_rows is None:
        return False
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return not sizes.filter(F.col("_n") > max_rows).isEmpty()


def split_hot(df: DataFrame, keys: Sequence[str], max_rows: int | None = MAX_ROWS_PER_KEY) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys with at most `max_rows` rows, rows of the other keys or None if there are none).

    NULL is a key like any other. A table of n rows has at most n / max_rows hot keys; they are written once and
    Spark chooses how to join them.
    """
    if max_rows is None:
        return df, None
    sizes = df.groupBy(*[F.col(k).alias(f"_h_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    hot = stored(sizes.filter(F.col("_n") > max_rows).drop("_n"), "hot-keys")
    if hot.isEmpty():
        return df, None
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys])
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numbered(df: DataFrame) -> DataFrame:
    # Row ids depend on the order of rows within a partition. Reading them back
    # from storage fixes that order, also for a task that runs a second time.
    return cut_lineage(df).withColumn("_row", F.monotonically_increasing_id())


def range_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], partitions: int | None = None
) -> DataFrame:
    """Rows in global (keys, order) order, cut into balanced chunks numbered by `_chunk`.

    The row id `_row` makes every sort key distinct, so that even equal rows can
    be cut apart. The result is checkpointed: cut points come from a sample, and
    all readers must see the same ones.
    """
    ranged = _numbered(df).repartitionByRange(partitions or _partitions(df), *keys, *order, "_row")
    return cut_lineage(ranged.withColumn("_chunk", F.spark_partition_id()))


def carry_in(
    per_key: DataFrame, keys: Sequence[str], combine: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """What each chunk inherits from the chunks before it.

    `per_key` has one row per chunk and key, with a column for each name in
    `combine`. A key that continues from one chunk into the next is the last of
    the former and the first of the latter, so one row per chunk is enough: the
    key that continues, as `_carry_key`, and its values combined so far.
    """
    key, names = F.struct(*keys), list(combine)
    ends = per_key.groupBy("_chunk").agg(
        F.min(key).alias("_first"), F.max(key).alias("_last"), F.max_by(F.struct(*names), key).alias("_values")
    )
    # These windows run over one row per chunk.
    so_far = Window.partitionBy("_last").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    in_order = Window.orderBy("_chunk")
    out = ends.withColumns({f"_out_{n}": fn(F.col(f"_values.{n}")).over(so_far) for n, fn in combine.items()})
    before = out.withColumns(
        {"_before": F.lag("_last").over(in_order), **{f"_in_{n}": F.lag(f"_out_{n}").over(in_order) for n in names}}
    )
    continues = F.col("_before").eqNullSafe(F.col("_first"))
    return before.select(
        "_chunk",
        F.col("_first").alias("_carry_key"),
        *[F.when(continues, F.col(f"_in_{n}")).alias(f"_carry_{n}") for n in names],
    )


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    step: int,
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Add `value` of the next (step 1) or previous (step -1) row of the same key in `order`.

    Only rows of keys with more than `max_rows_per_key` rows are cut into chunks; all others go by one window.
    """
    shift = F.lead if step > 0 else F.lag
    plain, hot = split_hot(df, keys, max_rows_per_key)
    plain = plain.withColumn(name, shift(value).over(Window.partitionBy(*keys).orderBy(*order)))
    if hot is None:
        return plain

    chunks = range_chunks(hot, keys, order)
    key = F.struct(*keys)
    inner = Window.partitionBy("_chunk", *keys).orderBy(*order, "_row")
    # The row at the near end of each chunk: as many rows as there are partitions.
    edge = F.struct(key.alias("key"), F.struct(*order, "_row").alias("at"), F.col(value).alias("value"))
    edges = chunks.groupBy("_chunk").agg((F.min(edge) if step > 0 else F.max(edge)).alias("edge"))
    beside = edges.select(
        "_chunk",
        shift("edge.key").over(Window.orderBy("_chunk")).alias("_k"),
        shift("edge.value").over(Window.orderBy("_chunk")).alias("_v"),
    )
    stitched = (
        chunks.withColumn("_inner", shift(value).over(inner))
        .withColumn("_end", shift(F.lit(True)).over(inner).isNull())
        .join(F.broadcast(beside), "_chunk", "left")
        .withColumn(name, F.when(~F.col("_end"), F.col("_inner")).when(F.col("_k").eqNullSafe(key), F.col("_v")))
        .drop("_row", "_chunk", "_inner", "_end", "_k", "_v")
    )
    return plain.unionByName(stitched)


def balanced_buckets(
    df: DataFrame, order: Sequence[str], buckets: int, name: str = "bucket", partitions: int | None = None
) -> DataFrame:
    """Split rows in `order` into `buckets` groups whose sizes differ by at most one.

    Same numbering as `ntile(buckets) OVER (ORDER BY ..)`, which would put the
    whole table into one task. Here the rows are range-sorted over many tasks;
    a row's global position is its position inside its chunk plus the rows of
    all chunks before it.
    """
    ranged = _numbered(df).repartitionByRange(partitions or _partitions(df), *order, "_row")
    sorted_rows = ranged.sortWithinPartitions(*order, "_row").drop("_row")
    # The id's low 33 bits count rows inside a partition, its high bits number the partition.
    placed = cut_lineage(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumns(
        {"_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)), "_chunk": F.shiftright("_id", 33)}
    ).drop("_id")
    sizes = placed.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_chunk",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    # The first `_total % buckets` groups have one row more than the others.
    bucket = F.expr(f"""
        CASE WHEN _before + _pos < (_total % {buckets}) * (_total div {buckets} + 1)
             THEN (_before + _pos) div (_total div {buckets} + 1)
             ELSE _total % {buckets}
                  + (_before + _pos - (_total % {buckets}) * (_total div {buckets} + 1)) div (_total div {buckets})
        END + 1""")
    return (
        placed.join(F.broadcast(offsets), "_chunk")
        .withColumn(name, bucket.cast("int"))
        .drop("_pos", "_chunk", "_before", "_total")
    )
