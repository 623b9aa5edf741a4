"""Change events as a stream into type 1 and type 2 tables.

What is stored is a log with one folder per micro-batch, and the table is derived
from it when read. A micro-batch therefore writes no more than itself, however
large the table has grown; events may arrive in any order, since order is only
ever taken from the sequence column; and a replayed batch rewrites its own folder.
`fold_scd1` shortens a log by writing its current state as one batch;
`refresh_scd2` keeps a stored copy of the history, rewriting only what changed.
`stream_scd1_stored` keeps the type 1 table itself: it is read as it is, and a
micro-batch reads and rewrites only the key buckets it has events for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions.columns import ColumnLike, as_column, is_true
from stratalake.operators.history import newest_events, scd2
from stratalake.operators.ordering import MAX_ROWS_PER_KEY
from stratalake.sources.buckets import BUCKET, ROWS_PER_BUCKET, grow, open_buckets, read_buckets, write_buckets
from stratalake.sources.storage import fixed_buckets, read_progress, remove_folder, save_progress, stored
from stratalake.sources.swap import finish_replacement
from stratalake.sources.tables import write_parquet
from stratalake.streaming.files import run_batches

SEQUENCE, DELETED, BATCH = "__seq", "__deleted", "_batch_id"


def _tagged(events: DataFrame, sequence_by: ColumnLike, delete_when: ColumnLike) -> DataFrame:
    return events.withColumns({SEQUENCE: as_column(sequence_by), DELETED: is_true(delete_when)})


def stream_scd1(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: ColumnLike,
    delete_when: ColumnLike,
    log: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
) -> StreamingQuery:
    """Keep the newest event per key and batch, deletes as tombstones.

    A tombstone stays in the log, so an update that arrives late cannot bring a
    deleted key back.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = newest_events(_tagged(batch, sequence_by, delete_when), keys, SEQUENCE, tiebreak)
        newest.write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")

    return run_batches(events, write, checkpoint)


def read_scd1(
    spark: SparkSession, log: str, keys: Sequence[str], except_columns: Sequence[str] = (), tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Current state per key."""
    newest = newest_events(spark.read.parquet(log), keys, SEQUENCE, tiebreak)
    return newest.filter(~F.col(DELETED)).drop(SEQUENCE, DELETED, BATCH, *except_columns)


def fold_scd1(
    spark: SparkSession, log: str, folded: str, keys: Sequence[str], tiebreak: Sequence[str] = ()
) -> None:
    """Write the log's newest event per key, tombstones included, as the only batch of a new log."""
    newest = newest_events(spark.read.parquet(log), keys, SEQUENCE, tiebreak).drop(BATCH)
    newest.write.mode("overwrite").parquet(f"{folded}/{BATCH}=-1")


def stream_scd1_stored(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: ColumnLike,
    delete_when: ColumnLike,
    target: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> StreamingQuery:
    """Upsert each micro-batch into a stored table; read it with `read_scd1_stored`.

    Every key keeps its newest sequence, a deleted one as a tombstone, so events that arrive late or again change
    nothing. Of events equal in sequence and `tiebreak` the first to arrive stays. The table starts with `buckets`
    buckets and splits them as it grows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_newest(_tagged(batch, sequence_by, delete_when), target, keys, tiebreak, buckets, rows_per_bucket)

    return run_batches(events, write, checkpoint)


def upsert_newest(
    tagged: DataFrame,
    target: str,
    keys: Sequence[str],
    tiebreak: Sequence[str] = (),
    buckets: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> list[int]:
    """Upsert events that carry sequence and deletion mark; the buckets that were rewritten."""
    spark = tagged.sparkSession
    finish_replacement(spark, target)
    bucket = open_buckets(spark, target, buckets).of(keys)
    fresh = stored(newest_events(tagged, keys, SEQUENCE, tiebreak).withColumn(BUCKET, bucket), "scd1-batch")
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    if not touched:
        return []
    both = fresh.withColumn("_kept", F.lit(False))
    known = read_buckets(spark, target, touched)
    if known is not None:
        both = both.unionByName(known.withColumn("_kept", F.lit(True)), allowMissingColumns=True)
    newest = newest_events(both, keys, SEQUENCE, [*tiebreak, "_kept"]).drop("_kept")
    write_buckets(newest, target, touched)
    grow(spark, target, keys, touched, rows_per_bucket)
    return touched


def read_scd1_stored(spark: SparkSession, target: str, except_columns: Sequence[str] = ()) -> DataFrame:
    """Current state per key of a table that `stream_scd1_stored` keeps."""
    return spark.read.parquet(target).filter(~F.col(DELETED)).drop(SEQUENCE, DELETED, BUCKET, *except_columns)


def stream_scd2(
    events: DataFrame,
    keys: Sequence[str],
    sequence_by: ColumnLike,
    delete_when: ColumnLike,
    log: str,
    checkpoint: str,
    buckets: int | None = None,
) -> StreamingQuery:
    """Append each micro-batch of events to the log, in folders by key bucket.

    The number of buckets is settled by the first run (64 if not given) and kept beside the log.
    """
    buckets = fixed_buckets(events.sparkSession, log, buckets)

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = _tagged(batch, sequence_by, delete_when).withColumn(
            BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        )
        # Few files per bucket; AQE cuts a bucket that is too large for one task.
        placed = tagged.hint("rebalance", BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{log}/{BATCH}={batch_id}")

    return run_batches(events, write, checkpoint)


def read_scd2(
    spark: SparkSession,
    log: str,
    keys: Sequence[str],
    except_columns: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    only_keys: DataFrame | None = None,
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Full history as [__START_AT, __END_AT), of all keys or of those in `only_keys`."""
    events = spark.read.parquet(log)
    if only_keys is not None:
        events = events.join(only_keys.select(*keys).distinct(), list(keys), "left_semi")
    hidden = [SEQUENCE, DELETED, BATCH, BUCKET, *except_columns]
    return scd2(events, keys, SEQUENCE, DELETED, hidden, tiebreak, max_rows_per_key)


def refresh_scd2(
    spark: SparkSession,
    log: str,
    target: str,
    progress: str,
    keys: Sequence[str],
    except_columns: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> int | None:
    """Bring a stored history up to date with its log; None when it already is.

    Only buckets that the batches since the last refresh touched are read and
    rewritten. All events of a key are in one bucket, so events that arrive late
    are placed correctly, and running a refresh again rewrites the same folders.
    """
    events = spark.read.parquet(log)
    done = read_progress(spark, progress, target, default=-1)
    # One row: the newest batch, and no more values than there are buckets.
    fresh = events.filter(F.col(BATCH) > done).agg(F.max(BATCH).alias("newest"), F.collect_set(BUCKET).alias("touched"))
    newest, touched = fresh.first()
    if newest is None:
        return None
    known = events.filter(F.col(BUCKET).isin(touched) & (F.col(BATCH) <= newest))
    hidden = [SEQUENCE, DELETED, BATCH, *except_columns]
    history = scd2(known, keys, SEQUENCE, DELETED, hidden, tiebreak, max_rows_per_key)
    history = stored(history, "history")
    write_parquet(history.hint("rebalance", BUCKET), target, partition_by=[BUCKET])
    # An overwrite leaves a bucket alone for which it has no rows.
    for emptied in set(touched) - {r[BUCKET] for r in history.select(BUCKET).distinct().collect()}:
        remove_folder(spark, f"{target.rstrip('/')}/{BUCKET}={emptied}")
    save_progress(spark, progress, target, log, newest)
    return newest
