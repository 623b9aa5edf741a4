"""Upsert and DML as DataFrame operators: the result is the new content of the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.columns import ColumnLike, as_column, is_true
from stratalake.operators.drift import evolve
from stratalake.operators.quality import guard
from stratalake.sources.storage import stored
from stratalake.sources.swap import finish_replacement, folders_of, replace_partitions

# In clause conditions and values, target columns are `t.<name>` and source columns `s.<name>`.
ALL = "*"


@dataclass(frozen=True)
class Update:
    """SET the given target columns ({name: value}), or all of them from the source with "*"."""

    values: Mapping[str, ColumnLike] | str = ALL
    when: ColumnLike | None = None


@dataclass(frozen=True)
class Delete:
    when: ColumnLike | None = None


@dataclass(frozen=True)
class Insert:
    """INSERT the given columns (the rest is NULL), or all of them from the source with "*"."""

    values: Mapping[str, ColumnLike] | str = ALL
    when: ColumnLike | None = None


def _same_key(keys: Sequence[str], null_safe: bool) -> Column:
    def pair(k: str) -> Column:
        t, s = F.col(f"t.`{k}`"), F.col(f"s.`{k}`")
        return t.eqNullSafe(s) if null_safe else t == s

    return reduce(lambda a, b: a & b, [pair(k) for k in keys])


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key and `_n`, the number of rows it stands for.

    Each column by itself, so that only those in use are shuffled; all of them meet the rows in the same order, and `first`
    takes that of the same row.
    """
    rest = [F.first(F.col(f"`{c}`")).alias(c) for c in source.columns if c not in keys]
    return source.groupBy(*keys).agg(*rest, F.count(F.lit(1)).alias("_n"))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    not_matched_by_source: Sequence[Update | Delete] = (),
    null_safe: bool = False,
    source_unique: bool = False,
) -> DataFrame:
    """MERGE `source` into `target` on equal keys. Per row the first clause that applies wins.

    Two source rows for one target row are an error, unless `source_unique` says
    there are none. Source rows without a target row are all inserted, repeated
    keys included. NULL keys match nothing, unless `null_safe`.

    The target is only ever the streamed side of left and semi joins: a source
    small enough for Spark to broadcast merges into a table of any size without
    shuffling that table, and otherwise AQE can split a skewed key. (A full outer
    join allows neither.) The source is read more than once, so give it as a
    table rather than as a costly computation.
    """
    keys = list(on)
    rows = target
    if matched or not_matched_by_source:
        rows = _target_rows(target, source, keys, matched, not_matched_by_source, null_safe, source_unique)
    if not not_matched:
        return rows
    return rows.unionByName(_inserted_rows(target, source, keys, not_matched, null_safe))


def _target_rows(target, source, keys, matched, unmatched, null_safe, source_unique):
    side = source.withColumn("_n", F.lit(1)) if source_unique else one_row_per_key(source, keys)
    joined = target.alias("t").join(side.alias("s"), _same_key(keys, null_safe), "left")
    hit = F.col("s._n").isNotNull()
    if matched and not source_unique:
        joined = guard(joined, ~hit | (F.col("s._n") <= 1), "several source rows match one target row")

    clauses = [(hit, c) for c in matched] + [(~hit, c) for c in unmatched]
    action = reduce(
        lambda chain, item: chain.when(item[1][0] & _applies(item[1][1]), item[0]),
        enumerate(clauses),
        F.when(F.lit(False), -1),
    ).otherwise(-1)
    acted = joined.withColumn("_action", action)
    deletes = [i for i, (_, clause) in enumerate(clauses) if isinstance(clause, Delete)]
    if deletes:
        acted = acted.filter(~F.col("_action").isin(deletes))

    columns = []
    for field in target.schema:
        value = F.col(f"t.`{field.name}`")
        chain = None
        for i, (_, clause) in enumerate(clauses):
            if isinstance(clause, Delete):
                continue
            new = _value(clause.values, field.name)
            if new is not None:
                test = F.col("_action") == i
                new = new.cast(field.dataType)
                chain = F.when(test, new) if chain is None else chain.when(test, new)
        columns.append((value if chain is None else chain.otherwise(value)).alias(field.name))
    return acted.select(*columns)


def _inserted_rows(target, source, keys, not_matched, null_safe):
    # Only target keys that occur in the source are kept, so this stays as small as the source.
    wanted = source.select(*keys)
    found = target.select(*keys).alias("t").join(wanted.alias("s"), _same_key(keys, null_safe), "left_semi").distinct()
    fresh = source.alias("s").join(found.alias("t"), _same_key(keys, null_safe), "left_anti").alias("s")
    action = reduce(
        lambda chain, item: chain.when(_applies(item[1]), item[0]), enumerate(not_matched), F.when(F.lit(False), -1)
    )
    fresh = fresh.withColumn("_action", action).filter(F.col("_action").isNotNull())
    columns = []
    for field in target.schema:
        chain = F.when(F.lit(False), F.lit(None).cast(field.dataType))
        for i, clause in enumerate(not_matched):
            new = _value(clause.values, field.name)
            if new is not None:
                chain = chain.when(F.col("_action") == i, new.cast(field.dataType))
        columns.append(chain.alias(field.name))
    return fresh.select(*columns)


def _applies(clause: Update | Delete | Insert) -> Column:
    return F.lit(True) if clause.when is None else is_true(clause.when)


def _value(values: Mapping[str, ColumnLike] | str, name: str) -> Column | None:
    if values == ALL:
        return F.col(f"s.`{name}`")
    return as_column(values[name]) if name in values else None


#: Partitions that a merge names to the scan one by one.
MAX_LISTED_PARTITIONS = 500


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def touched_partitions(
    target: DataFrame, source: DataFrame, partition_by: Sequence[str], not_matched_by_source: Sequence[Update | Delete] = ()
) -> DataFrame:
    """The rows of the partitions of `target` that a merge may change.

    These are the partitions the source has rows for and those with rows that a by-source clause applies to. They are
    named to the scan as literals; more than MAX_LISTED_PARTITIONS of them are found by a join.
    """
    names = list(partition_by)
    touched = source.select(*names)
    if not_matched_by_source:
        applies = _any([_applies(c) for c in not_matched_by_source])
        touched = touched.union(target.alias("t").filter(applies).select(*[F.col(f"t.`{c}`") for c in names]))
    touched = touched.distinct()
    values = touched.limit(MAX_LISTED_PARTITIONS + 1).collect()
    if len(values) > MAX_LISTED_PARTITIONS:
        return target.join(touched, names, "left_semi")
    if len(names) == 1:
        return target.filter(F.col(names[0]).isin([r[0] for r in values]))
    return target.filter(_any([reduce(lambda a, b: a & b, [F.col(c) == F.lit(r[c]) for c in names]) for r in values]))


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    on: Sequence[str],
    partition_by: Sequence[str] = (),
    matched: Sequence[Update | Delete] = (),
    not_matched: Sequence[Insert] = (),
    not_matched_by_source: Sequence[Update | Delete] = (),
    **options: bool,
) -> None:
    """MERGE with all its clauses into a stored table, reading and rewriting only partitions that may change.

    The partition columns must be part of the key and not NULL in the source; a table without partitions is replaced
    as a whole. A partition whose last row is deleted goes, so a partitioned table without any rows is an empty
    folder. New content is complete in storage before any old folder is replaced, rows are written once, and a
    run that was killed is finished by the next one; merging the same source again gives the same table.
    """
    names = list(partition_by)
    if not set(names) <= set(on):
        raise ValueError("partition columns must be part of the key")
    finish_replacement(spark, path)
    for column in names:
        source = guard(source, F.col(column).isNotNull(), f"NULL in partition column {column}")
    source = stored(source, "merge-source")
    target = spark.read.parquet(path)
    if names:
        target = touched_partitions(target, source, names, not_matched_by_source)
    merged = merge(target, source, on, matched, not_matched, not_matched_by_source, **options)
    replace_partitions(merged, path, names, folders_of(target, len(names)))


def update_where(df: DataFrame, condition: ColumnLike, values: Mapping[str, ColumnLike]) -> DataFrame:
    """UPDATE .. SET .. WHERE: every value is computed from the row before the update."""
    hit = is_true(condition)
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {c: F.when(hit, as_column(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
    )


def delete_where(df: DataFrame, condition: ColumnLike) -> DataFrame:
    """DELETE WHERE: a row whose condition is NULL is kept."""
    return df.filter(~is_true(condition))


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT with a column list: columns `rows` does not have are NULL."""
    return evolve([df, rows]).select(*df.columns)
