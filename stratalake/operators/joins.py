"""Enrichment, dropped rows and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.ordering import MAX_ROWS_PER_KEY, carry_in, has_hot_key, range_chunks
from stratalake.sources.storage import stored

#: What every executor and the driver can be asked to hold.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    columns: Sequence[str],
    status: str = "_join_status",
) -> DataFrame:
    """Left join that keeps every fact row and says whether it found its dimension row.

    There is no hint: a side whose bytes are below the session's threshold is broadcast, by estimate or by what AQE
    measures, and AQE splits a skewed key otherwise.

    The status comes from a marker column, so a matched row whose attributes
    are NULL still counts as matched.
    """
    keys = [on] if isinstance(on, str) else list(on)
    side = dim.select(*keys, *columns, F.lit(True).alias("_hit"))
    joined = fact.join(side, keys, "left")
    return joined.withColumn(status, F.when(F.col("_hit"), "matched").otherwise("unmatched")).drop("_hit")


def dropped_between(before: DataFrame, after: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of one layer that the next layer does not have."""
    keys = [on] if isinstance(on, str) else list(on)
    return before.join(after.select(*keys), keys, "left_anti")


def join_sort_merge(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Ask for a sort-merge join in this query only, without touching session settings."""
    return left.join(right.hint("merge"), [on] if isinstance(on, str) else list(on), how)


def valid_on(dim: DataFrame, day: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """The dimension as it was on one day; both interval ends are inclusive."""
    date = F.lit(day).cast("date")
    return dim.filter((F.col(valid_from) <= date) & (F.col(valid_to) >= date))


def join_broadcast(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Ask for a broadcast join in this query only, where `right` is measured to be small enough.

    `right` is stored and the bytes of its rows are added up, uncompressed; above `max_bytes` there is no hint and Spark
    chooses. `how` must keep the rows of `left` apart: a broadcast right side cannot serve right or full joins.
    """
    if how.replace("_", "") not in ("inner", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"):
        raise ValueError(f"a {how} join cannot broadcast its right side")
    side = stored(right, "broadcast-side")
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in side.columns])))
    measured = side.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return left.join(F.broadcast(side) if measured <= max_bytes else side, [on] if isinstance(on, str) else list(on), how)


def join_as_of(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    at: str,
    columns: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
    end_inclusive: bool = True,
    max_versions: int = 64,
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Each fact row with the dimension version valid at its own time.

    Times of facts are compared as the type of `valid_from`, so a TIMESTAMP fact
    falls on its day in a dimension of dates. A NULL `valid_to` means that the version is still in force. Ends belong
    to their interval unless `end_inclusive` is False, as in histories whose versions end where the next one starts.
    Overlapping intervals of a key are refused.

    Facts are joined by key and range where a key has at most `max_versions` versions. Facts and versions of the
    other keys, and of these only, are ordered together and the last version is carried forward: that work is
    linear in facts plus versions, where a range join would look at every pair. Both give the same rows.
    """
    keys = list(on)
    ahead = Window.partitionBy(*keys).orderBy(valid_from, F.col(valid_to).asc_nulls_last())
    begin, end = F.col(valid_from), F.col(valid_to)
    known = dim.filter(begin.isNotNull() & (end.isNull() | ((begin <= end) if end_inclusive else (begin < end))))
    for k in keys:
        known = known.filter(F.col(k).isNotNull())  # NULL keys never match
    before = F.lag(F.struct(valid_to)).over(ahead)
    reaches = (before[valid_to] >= begin) if end_inclusive else (before[valid_to] > begin)
    overlap = before.isNotNull() & F.coalesce(reaches, F.lit(True))
    versions = known.select(*keys, overlap.alias("over")).groupBy(*keys)
    versions = versions.agg(F.count(F.lit(1)).alias("n"), F.count_if("over").alias("over"))
    shape = versions.agg(F.max("n").alias("most"), F.sum("over").alias("over")).first()
    if shape["over"]:
        raise ValueError(f"{shape['over']} intervals of the dimension overlap the one before them")
    named = {"valid_from": valid_from, "valid_to": valid_to, "how": how, "end_inclusive": end_inclusive}
    if (shape["most"] or 0) <= max_versions:
        return _join_range(fact, known, keys, at, columns, **named)
    many = stored(versions.filter(F.col("n") > max_versions).select(*keys), "keys-of-many-versions")
    plain = _join_range(fact.join(many, keys, "left_anti"), known.join(many, keys, "left_anti"), keys, at, columns, **named)
    ordered = _carry_version(
        fact.join(many, keys, "left_semi"), known.join(many, keys, "left_semi"), keys, at, columns,
        max_rows_per_key=max_rows_per_key, **named,
    )
    return plain.select(*fact.columns, *columns).unionByName(ordered.select(*fact.columns, *columns))


def _join_range(fact, known, keys, at, columns, valid_from, valid_to, how, end_inclusive):
    side = known.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *[F.col(c).alias(f"_c_{c}") for c in columns])
    moment = F.col(at).cast(known.schema[valid_from].dataType)
    condition = (moment >= F.col("_from")) & _until(moment, F.col("_to"), end_inclusive)
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_k_{k}"))
    joined = fact.join(side, condition, how)
    return joined.select(*fact.columns, *[F.col(f"_c_{c}").alias(c) for c in columns])


def _until(moment, end, inclusive: bool):
    return end.isNull() | ((moment <= end) if inclusive else (moment < end))


def _carry_version(fact, dim, keys, at, columns, valid_from, valid_to, how, end_inclusive, max_rows_per_key):
    version_type = dim.select(F.struct(valid_to, *columns)).schema[0].dataType
    fact_type = fact.select(F.struct(*fact.columns)).schema[0].dataType
    at_type = dim.schema[valid_from].dataType
    timeline = fact.select(
        *keys,
        F.col(at).cast(at_type).alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*fact.columns).alias("_fact"),
        F.lit(None).cast(version_type).alias("_version"),
    ).unionByName(
        dim.select(
            *keys,
            F.col(valid_from).alias("_at"),
            F.lit(0).alias("_kind"),
            F.lit(None).cast(fact_type).alias("_fact"),
            F.struct(valid_to, *columns).alias("_version"),
        )
    )
    if has_hot_key(timeline, keys, max_rows_per_key):
        carried = _carry_over_chunks(timeline, keys)
    else:
        w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
        carried = timeline.withColumn("_found", F.last("_version", ignorenulls=True).over(w))
    carried = carried.filter(F.col("_fact").isNotNull())
    in_force = F.col("_found").isNotNull() & _until(F.col("_at"), F.col(f"_found.{valid_to}"), end_inclusive)
    for k in keys:
        in_force = in_force & F.col(k).isNotNull()  # NULL keys never match
    in_force = F.coalesce(in_force & F.col("_at").isNotNull(), F.lit(False))
    if how == "inner":
        return carried.filter(in_force).select("_fact.*", *[F.col(f"_found.{c}").alias(c) for c in columns])
    return carried.select("_fact.*", *[F.when(in_force, F.col(f"_found.{c}")).alias(c) for c in columns])


def _carry_over_chunks(timeline: DataFrame, keys: list[str]) -> DataFrame:
    """Carry forward where one key may span many tasks: within chunks, then across their ends."""
    chunks = range_chunks(timeline, keys, ["_at", "_kind"])
    when_seen = F.when(F.col("_version").isNotNull(), F.struct("_at", "_row"))
    last_seen = chunks.groupBy("_chunk", *keys).agg(F.max_by("_version", when_seen).alias("version"))
    carried = carry_in(last_seen, keys, {"version": lambda c: F.last(c, ignorenulls=True)})
    w = Window.partitionBy("_chunk", *keys).orderBy("_at", "_kind", "_row").rowsBetween(Window.unboundedPreceding, 0)
    inherited = F.when(F.struct(*keys).eqNullSafe(F.col("_carry_key")), F.col("_carry_version"))
    return (
        chunks.withColumn("_inside", F.last("_version", ignorenulls=True).over(w))
        .join(F.broadcast(carried), "_chunk", "left")
        .withColumn("_found", F.coalesce("_inside", inherited))
    )
