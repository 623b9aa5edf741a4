"""Window metrics over aggregated tables, and top-n."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.columns import percent_change
from stratalake.operators.ordering import MAX_ROWS_PER_KEY, carry_in, has_hot_key, range_chunks, split_hot, with_neighbour


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_r_{c}"]) for c in columns])


def _join_back(df: DataFrame, side: DataFrame, on: Sequence[str], added: Sequence[str]) -> DataFrame:
    right = side.select(*[F.col(c).alias(f"_r_{c}") for c in on], *added)
    return df.join(right, _same(df, right, on), "left").drop(*[f"_r_{c}" for c in on])


#: Types whose equal values are one member of a set.
_PLAIN = ("tinyint", "smallint", "int", "bigint", "date", "string")


def aggregate_with_distinct(
    df: DataFrame,
    grain: Sequence[str],
    measures: Sequence[Column],
    distinct: dict[str, str],
    max_rows_per_group: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Measures and exact distinct counts ({name: column}) per grain.

    Rows are shuffled once, as they are, and each group's distinct values are collected where its rows are. Spark's own
    plan makes a row for each count out of each row and shuffles all of them twice; it is left for inputs with a group of
    more than `max_rows_per_group` rows, which no task should hold, and for other types than whole numbers, dates and
    text. None skips the check, which reads the grain of all rows, for a grain that is known to have small groups. NULL
    is a grain value like any other.
    """
    types = dict(df.dtypes)
    small = grain and all(types[c] in _PLAIN for c in distinct.values()) and not has_hot_key(df, grain, max_rows_per_group)
    rows = df.repartition(*grain) if small else df
    counts = [F.size(F.collect_set(c)).cast("bigint") if small else F.countDistinct(c) for c in distinct.values()]
    return rows.groupBy(*grain).agg(*measures, *[n.alias(name) for name, n in zip(distinct, counts)])


def with_ranks(
    df: DataFrame,
    group: Sequence[str],
    by: str,
    rank: str,
    dense_rank: str | None = None,
    max_rows_per_group: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """rank (and dense rank) of any column that can be ordered, highest first and NULL last, within each group.

    Where a group is too large for one task, ranks are found for its distinct
    values, in chunks, and joined back; the other groups go by one window.
    """
    names = [rank, *([dense_rank] if dense_rank else [])]
    plain, hot = split_hot(df, group, max_rows_per_group)
    w = Window.partitionBy(*group).orderBy(F.col(by).desc())
    plain = plain.withColumns(dict(zip(names, [F.rank().over(w), F.dense_rank().over(w)])))
    if hot is None:
        return plain

    values = hot.groupBy(*group, by).agg(F.count(F.lit(1)).alias("_n"))
    down = F.col(by).desc_nulls_last()
    chunks = range_chunks(values, group, [down])
    totals = chunks.groupBy("_chunk", *group).agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("values"))
    carried = carry_in(totals, group, {"rows": F.sum, "values": F.sum})
    inner = Window.partitionBy("_chunk", *group).orderBy(down)
    above = inner.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.struct(*group).eqNullSafe(F.col("_carry_key"))

    def carry(name: str) -> Column:
        return F.coalesce(F.when(continues, F.col(f"_carry_{name}")), F.lit(0))

    ranked = (
        chunks.withColumns({"_above": F.coalesce(F.sum("_n").over(above), F.lit(0)), "_nth": F.row_number().over(inner)})
        .join(F.broadcast(carried), "_chunk", "left")
        .withColumns(
            dict(
                zip(
                    names,
                    [
                        (F.col("_above") + carry("rows") + 1).cast("int"),
                        (F.col("_nth") + carry("values")).cast("int"),
                    ],
                )
            )
        )
    )
    return plain.unionByName(_join_back(hot, ranked, [*group, by], names))


def with_running_total(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    value: str,
    name: str,
    dtype: str = "decimal(18,2)",
    max_steps_per_group: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Sum of `value` up to and including the row's `order` value.

    Rows that share an `order` value get the same total, so the result does not
    depend on how such ties happen to be sorted. Values are summed per group and
    `order` first; the window then runs over that table. Where a group has more than `max_steps_per_group` values of
    `order`, the steps are cut into ordered chunks: totals run within a chunk, and each chunk inherits the sum of those
    before it. None skips the check, for an `order` that is known to have few values.
    """
    steps = df.groupBy(*group, order).agg(F.sum(value).alias("_step"))
    if has_hot_key(steps, group, max_steps_per_group):
        totals = _running_over_chunks(steps, group, order)
    else:
        w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        totals = steps.withColumn("_total", F.sum("_step").over(w))
    return _join_back(df, totals.withColumn(name, F.col("_total").cast(dtype)), [*group, order], [name])


def _running_over_chunks(steps: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    chunks = range_chunks(steps, group, [order])
    sums = chunks.groupBy("_chunk", *group).agg(F.sum("_step").alias("sum"))
    carried = carry_in(sums, group, {"sum": F.sum})
    w = Window.partitionBy("_chunk", *group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.when(F.struct(*group).eqNullSafe(F.col("_carry_key")), F.col("_carry_sum"))
    inside = chunks.withColumn("_inside", F.sum("_step").over(w)).join(F.broadcast(carried), "_chunk", "left")
    return inside.withColumn("_total", F.when(F.col("_inside").isNull(), before).otherwise(F.col("_inside") + F.coalesce(before, F.lit(0))))


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order: str | Sequence[str],
    value: str,
    name: str,
    max_rows_per_group: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """`value` of the row before, within each group."""
    by = [order] if isinstance(order, str) else list(order)
    return with_neighbour(df, group, by, value, name, -1, max_rows_per_group)


def with_percent_change(df: DataFrame, current: str, previous: str, name: str, scale: int = 2) -> DataFrame:
    """Change in percent; NULL without a previous value or where it is zero."""
    return df.withColumn(name, percent_change(F.col(current), F.col(previous), scale))


def top_n_per_group(df: DataFrame, group: Sequence[str], by: str, n: int, name: str = "rank") -> DataFrame:
    """Rows with rank <= n. Spark applies the limit on the map side before it shuffles."""
    w = Window.partitionBy(*group).orderBy(F.col(by).desc())
    return df.withColumn(name, F.rank().over(w)).filter(F.col(name) <= n)
