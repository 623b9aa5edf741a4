"""Dimension history: type 1 and type 2 from events, and type 2 from batches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.columns import ColumnLike, as_column, is_true, key_hash
from stratalake.operators.merge import one_row_per_key
from stratalake.operators.ordering import MAX_ROWS_PER_KEY, with_neighbour
from stratalake.operators.quality import guard

START, END = "__START_AT", "__END_AT"
OPEN_END = "9999-12-31"


# --- from events -----------------------------------------------------------


def newest_events(
    events: DataFrame, keys: Sequence[str], sequence_by: ColumnLike, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The last event per key, deletes included."""
    order = Window.partitionBy(*keys).orderBy(as_column(sequence_by).desc(), *[F.col(t).desc() for t in tiebreak])
    return events.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def scd1(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: ColumnLike,
    delete_when: ColumnLike,
    except_columns: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest state per key, in whatever order the events arrive; deleted keys are gone."""
    last = newest_events(events, keys, sequence_by, tiebreak)
    return last.filter(~is_true(delete_when)).drop(*except_columns)


def scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: ColumnLike,
    delete_when: ColumnLike,
    except_columns: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """All states per key as [__START_AT, __END_AT); NULL end is the current one.

    A delete closes the state before it and gives no row. Of several events at
    the same point of the sequence only the last by `tiebreak` is ever in force,
    so redelivered events change nothing. A key with more than
    `max_rows_per_key` events is worked on by several tasks.
    """
    started = events.withColumn(START, as_column(sequence_by))
    ended = with_neighbour(started, list(keys), [START, *tiebreak], START, END, 1, max_rows_per_key)
    in_force = F.col(END).isNull() | (F.col(END) > F.col(START))
    return ended.filter(in_force & ~is_true(delete_when)).drop(*except_columns)


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END).isNull())


def deleted_keys(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without a current state, and since when."""
    ends = history.groupBy(*keys).agg(
        F.max(END).alias("deleted_at"), F.count_if(F.col(END).isNull()).alias("_open")
    )
    return ends.filter("_open = 0").drop("_open")


# --- from batches ----------------------------------------------------------


def scd2_init(df: DataFrame, keys: Sequence[str], valid_from: str | Column) -> DataFrame:
    """First load: every row is the current version from `valid_from` on."""
    start = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    versions = df.withColumns(
        {
            "valid_from": start.cast("date"),
            "valid_to": F.lit(OPEN_END).cast("date"),
            "is_current": F.lit(True),
        }
    )
    return versions.withColumn("dim_sk", key_hash([*keys, "valid_from"]))


def _differs(tracked: Sequence[str], strict: bool) -> Column:
    def one(c: str) -> Column:
        t, s = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        return t != s if strict else ~t.eqNullSafe(s)

    return reduce(lambda a, b: a | b, [one(c) for c in tracked])


def detect_changes(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], strict_reference: bool = False
) -> DataFrame:
    """Batch rows that are new or differ from the current version in a tracked attribute.

    `strict_reference` keeps plain `!=`: new keys and changes from or to NULL go unnoticed.
    """
    on = reduce(lambda a, b: a & b, [F.col(f"s.`{k}`") == F.col(f"t.`{k}`") for k in keys])
    side = current.select(*keys, *tracked, F.lit(True).alias("_hit"))
    joined = batch.alias("s").join(side.alias("t"), on, "left")
    changed = _differs(tracked, strict_reference)
    if not strict_reference:
        changed = F.col("t._hit").isNull() | changed
    return joined.filter(changed).select("s.*")


def scd2_apply(
    dim: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], valid_from: str = "valid_from"
) -> DataFrame:
    """Close the versions a batch changes (one day before the new one) and add the new ones.

    Closed versions pass through untouched; the current ones meet the batch in
    one left join that gives each of them back as it is, or as the closed and
    the new version. A small batch is broadcast, so the dimension does not
    shuffle. Applying the same batch again changes nothing. A change dated like the current version corrects it
    in place, so intervals never turn around and `dim_sk` stays unique; a change dated before it is refused.
    """
    keys = list(keys)
    columns = dim.columns
    types = {f.name: f.dataType for f in dim.schema}
    start = F.col(f"s.`{valid_from}`").cast("date")
    new_values = {
        "valid_from": start,
        "valid_to": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
        "dim_sk": key_hash([*[F.col(f"s.`{k}`") for k in keys], start]),
    }

    def row(values: dict[str, Column], side: str) -> Column:
        return F.struct(
            *[values.get(c, F.col(f"{side}.`{c}`")).cast(types[c]).alias(c) for c in columns]
        )

    current = dim.filter("is_current")
    on = reduce(lambda a, b: a & b, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys])
    joined = current.alias("t").join(one_row_per_key(batch, keys).alias("s"), on, "left")
    hit = F.col("s._n").isNotNull()
    joined = guard(joined, ~hit | (F.col("s._n") <= 1), "several batch rows for one dimension key")
    changed = hit & _differs(tracked, False)
    since = F.col("t.valid_from")
    joined = guard(joined, ~changed | (start >= since), "a batch row is older than the current version of its key")
    corrected = {c: F.col(f"t.`{c}`") for c in ("valid_from", "valid_to", "is_current", "dim_sk")}
    closing = {"valid_to": F.date_sub(start, 1), "is_current": F.lit(False)}
    versions = (
        F.when(changed & (start == since), F.array(row(corrected, "s")))
        .when(changed, F.array(row(closing, "t"), row(new_values, "s")))
        .otherwise(F.array(row({}, "t")))
    )
    kept = joined.select(F.inline(versions))

    found = current.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()
    fresh = batch.join(found, keys, "left_anti").alias("s").select(row(new_values, "s").alias("r")).select("r.*")
    return dim.filter("NOT is_current").unionByName(kept).unionByName(fresh)
