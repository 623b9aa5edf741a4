"""Incremental propagation of a change feed from one layer to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.feed import CHANGE_TYPE, COMMITTED, DELETE, VERSION, apply_feed, as_of, collapse, feed_range
from stratalake.operators.merge import Insert, Update, merge
from stratalake.sources.buckets import BUCKET, ROWS_PER_BUCKET, grow, open_buckets, read_buckets, write_buckets
from stratalake.sources.storage import load_version, read_progress, save_progress, save_version, stored, subfolders
from stratalake.sources.swap import finish_replacement

DELETED = "_deleted"


def write_feed(changes: DataFrame, path: str) -> None:
    """Store a feed by version, so that a range of versions is a range of folders."""
    changes.write.mode("append").partitionBy(VERSION).parquet(path)


def propagate(
    spark: SparkSession,
    feed: DataFrame,
    target: str,
    progress: str,
    pipeline: str,
    keys: Sequence[str],
    source: str = "feed",
    buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> int | None:
    """Apply the versions that came after the last run; None when there are none.

    The target is kept in folders by key bucket, and only buckets with changes
    are read and rewritten. It begins with `buckets` of them and splits them as it grows. Deleted rows stay as
    tombstones, which `current_state` hides. New content is complete in storage before old folders are replaced,
    and progress is saved last: a crash in between applies the same versions once
    more, which gives the same state.
    """
    finish_replacement(spark, target)
    done = read_progress(spark, progress, pipeline, default=-1)
    bucket = open_buckets(spark, target, buckets).of(keys)
    # One row: the newest version, and no more values than there are buckets.
    pending = feed_range(feed, done + 1).agg(F.max(VERSION), F.collect_set(bucket))
    newest, touched = pending.first()
    if newest is None:
        return None
    # Stored, as the merge reads it more than once.
    changes = stored(collapse(feed_range(feed, done + 1, newest), keys).withColumn(BUCKET, bucket), "changes")
    table = read_buckets(spark, target, touched)
    if table is None:
        kept = changes.filter(F.col(CHANGE_TYPE) != DELETE).drop(CHANGE_TYPE, VERSION, COMMITTED)
        merged = kept.withColumn(DELETED, F.lit(False))
    else:
        merged = _merge_changes(table, changes, keys)
    write_buckets(merged, target, touched)
    grow(spark, target, keys, touched, rows_per_bucket)
    save_progress(spark, progress, pipeline, source, newest)
    return newest


def _merge_changes(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    gone = f"s.{CHANGE_TYPE} = '{DELETE}'"
    values = {c: f"s.`{c}`" for c in table.columns if c not in (DELETED, BUCKET)}
    return merge(
        table,
        changes,
        keys,
        matched=[
            Update({DELETED: F.lit(True)}, when=gone),
            Update({**{c: v for c, v in values.items() if c not in keys}, DELETED: F.lit(False)}),
        ],
        not_matched=[Insert({**values, DELETED: F.lit(False), BUCKET: f"s.{BUCKET}"}, when=f"NOT ({gone})")],
        source_unique=True,
    )


def current_state(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that `propagate` maintains."""
    return spark.read.parquet(target).filter(~F.col(DELETED)).drop(DELETED, BUCKET)


def save_snapshots(spark: SparkSession, feed: str, snapshots: str, keys: Sequence[str], every: int = 10) -> list[int]:
    """Store the table's state at every `every`-th version of a stored feed; the versions that were new.

    Each state is built on the one before it, so a version of the feed is read once for all snapshots.
    """
    newest = max((int(f.split("=")[1]) for f in subfolders(spark, feed) if f.startswith(f"{VERSION}=")), default=-1)
    known = _snapshot_versions(spark, snapshots)
    wanted = [v for v in range(0, newest + 1, every) if v not in known]
    for version in wanted:
        save_version(state_at(spark, feed, snapshots, version, keys), snapshots, version)
    return wanted


def _snapshot_versions(spark: SparkSession, snapshots: str) -> list[int]:
    return sorted(int(f.split("=")[1]) for f in subfolders(spark, snapshots))


def state_at(spark: SparkSession, feed: str, snapshots: str, version: int, keys: Sequence[str]) -> DataFrame:
    """The table as it was at `version`: the nearest snapshot at or before it, and the versions since.

    Both are chosen by folder, so nothing older than the snapshot and nothing newer than `version` is read.
    """
    before = [v for v in _snapshot_versions(spark, snapshots) if v <= version]
    changes = spark.read.parquet(feed)
    if not before:
        return as_of(changes, version, keys)
    state = load_version(spark, snapshots, before[-1])
    return state if before[-1] == version else apply_feed(state, feed_range(changes, before[-1] + 1, version), keys)
