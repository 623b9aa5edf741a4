"""Change feeds: build, select, collapse, apply, and rebuild a past state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.merge import Delete, Insert, Update, merge
from stratalake.operators.quality import guard
from stratalake.sources.storage import stored

CHANGE_TYPE, VERSION, COMMITTED = "_change_type", "_commit_version", "_commit_timestamp"
INSERT, PRE, POST, DELETE = "insert", "update_preimage", "update_postimage", "delete"


def _commit(df: DataFrame, version: int, timestamp: str | None) -> DataFrame:
    moment = F.current_timestamp() if timestamp is None else F.lit(timestamp).cast("timestamp")
    return df.withColumns({VERSION: F.lit(version).cast("bigint"), COMMITTED: moment})


def initial_feed(df: DataFrame, version: int = 0, timestamp: str | None = None) -> DataFrame:
    """The feed of a first load: every row is an insert."""
    return _commit(df.withColumn(CHANGE_TYPE, F.lit(INSERT)), version, timestamp)


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str], version: int, timestamp: str | None = None
) -> DataFrame:
    """What changed between two states of a table with a unique key.

    One full outer join; an update gives its old and its new row. Columns are
    compared null-safe. A key that a state has twice is refused: the grouping that finds it deals rows by the key,
    as the join does, and costs no shuffle of its own.
    """
    columns = after.columns

    def state(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*columns).alias(name)
        found = df.select(*keys, row).groupBy(*keys).agg(F.first(name).alias(name), F.count(F.lit(1)).alias("_n"))
        return guard(found, F.col("_n") == 1, f"a key is not unique in the {'old' if name == '_old' else 'new'} state").drop("_n")

    old, new = state(before, "_old"), state(after, "_new")

    def row(side: str, kind: str):
        return F.struct(*[F.col(f"{side}.`{c}`").alias(c) for c in columns], F.lit(kind).alias(CHANGE_TYPE))

    changes = (
        F.when(F.col("_old").isNull(), F.array(row("_new", INSERT)))
        .when(F.col("_new").isNull(), F.array(row("_old", DELETE)))
        .otherwise(F.array(row("_old", PRE), row("_new", POST)))
    )
    changed = old.join(new, list(keys), "full").filter(~F.col("_old").eqNullSafe(F.col("_new")))
    return _commit(changed.select(F.inline(changes)), version, timestamp)


def feed_range(feed: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """Versions low..high, both inclusive. On a feed partitioned by version this prunes folders."""
    selected = feed.filter(F.col(VERSION) >= low)
    return selected if high is None else selected.filter(F.col(VERSION) <= high)


def feed_counts(feed: DataFrame, name: str = "changes") -> DataFrame:
    return feed.groupBy(VERSION, CHANGE_TYPE).agg(F.count(F.lit(1)).alias(name))


def history(feed: DataFrame) -> DataFrame:
    """One row per version: rows inserted, updated and deleted."""
    kind = F.col(CHANGE_TYPE)
    return feed.groupBy(VERSION).agg(
        F.count_if(kind == INSERT).alias("inserted"),
        F.count_if(kind == POST).alias("updated"),
        F.count_if(kind == DELETE).alias("deleted"),
    )


def collapse(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change per key; preimages are dropped.

    Within one commit a surviving row beats a delete. The constant row-number
    filter keeps one row per key on the map side.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(VERSION).desc(), (F.col(CHANGE_TYPE) == DELETE).asc())
    relevant = feed.filter(F.col(CHANGE_TYPE) != PRE)
    return relevant.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def apply_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str], collapsed: bool = False) -> DataFrame:
    """Bring a target up to date: delete, update or insert by the last change of each key.

    The last changes are stored, as the merge reads them three times.
    """
    changes = feed if collapsed else stored(collapse(feed, keys), "collapsed")
    columns = {c: f"s.`{c}`" for c in target.columns}
    return merge(
        target,
        changes,
        keys,
        matched=[Delete(f"s.{CHANGE_TYPE} = '{DELETE}'"), Update({c: v for c, v in columns.items() if c not in keys})],
        not_matched=[Insert(columns, when=f"s.{CHANGE_TYPE} <> '{DELETE}'")],
        source_unique=True,
    )


def as_of(feed: DataFrame, version: int, keys: Sequence[str]) -> DataFrame:
    """The table as it was at a version, from a feed that starts with its first load."""
    past = collapse(feed.filter(F.col(VERSION) <= version), keys)
    return past.filter(F.col(CHANGE_TYPE) != DELETE).drop(CHANGE_TYPE, VERSION, COMMITTED)
