"""Incremental file ingest: each file once, restart from the checkpoint, drift handled per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from stratalake.operators.drift import RESCUED, evolve, rescue
from stratalake.sources.files import as_schema, files_by_header, read_csv, read_csv_strings, with_source_file

# What the file listing source reports; `content` is never read because it is never selected.
FILE_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    max_files: int = 10,
    source_column: str = "_source_file",
    full_path: bool = False,
    time_column: str = "_ingestion_timestamp",
    **options: str,
) -> DataFrame:
    """Stream of new files with ingestion time and source file; `max_files` per micro-batch."""
    if fmt == "csv":
        options = {"header": "true", "enforceSchema": "false", **options}
    stream = (
        spark.readStream.format(fmt)
        .schema(as_schema(schema))
        .option("maxFilesPerTrigger", max_files)
        .options(**options)
        .load(path)
    )
    return with_source_file(stream, source_column, full_path).withColumn(time_column, F.current_timestamp())


def run_append(
    df: DataFrame,
    target: str,
    checkpoint: str,
    table: bool = False,
    partition_by: Sequence[str] = (),
    on_progress: Callable[[StreamingQueryProgress], None] | None = None,
) -> StreamingQuery:
    """Append everything available now to a folder (or a catalog table), then stop.

    The same checkpoint continues where the last run ended. `on_progress` gets the progress of every micro-batch of
    this run once. The query keeps only the newest hundred, so they are taken while it runs; a gap raises.
    """
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.toTable(target) if table else writer.start(target)
    if on_progress is None:
        query.awaitTermination()
        return query
    last = None
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        for progress in query.recentProgress:
            if last is not None and progress.batchId > last + 1:
                raise RuntimeError(f"the progress of batches {last + 1} to {progress.batchId - 1} was lost")
            if last is None or progress.batchId > last:
                last = progress.batchId
                on_progress(progress)
    return query


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch with its id to `handle` until caught up.

    A batch that is replayed after a failure comes with the same id; the sinks
    here write to a folder named by that id, so a replay replaces its own output.
    """
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _new_paths(spark: SparkSession, path: str, max_files: int, pattern: str) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )


def _paths(batch: DataFrame) -> list[str]:
    # At most maxFilesPerTrigger names; the rows of these files stay on the executors.
    return [r["path"] for r in batch.collect()]


def stream_evolving(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: T.StructType | str | None = None,
    max_files: int = 10,
    pattern: str = "*.csv",
) -> StreamingQuery:
    """CSV ingest that takes up new columns as they appear; read the result with `read_lots`.

    A running file stream cannot change its schema, so the stream carries file
    names, and each micro-batch reads its files per header. Columns outside
    `schema` are text.
    """
    known = {f.name: f.dataType for f in as_schema(schema)} if schema is not None else {}

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        frames = []
        for header, members in files_by_header(session, _paths(batch)).items():
            lot = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
            frames.append(with_source_file(read_csv(session, members, lot)))
        if frames:
            rows = evolve(frames).withColumn("_ingestion_timestamp", F.current_timestamp())
            rows.write.mode("overwrite").parquet(f"{target}/_batch_id={batch_id}")

    return run_batches(_new_paths(spark, path, max_files, pattern), write, checkpoint)


def stream_rescued(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    max_files: int = 10,
    pattern: str = "*.csv",
    column: str = RESCUED,
) -> StreamingQuery:
    """CSV ingest under a fixed schema; whatever does not fit is kept in `column` as JSON."""

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        frames = [
            rescue(with_source_file(read_csv_strings(session, members)), schema, column, keep=["_source_file"])
            for members in files_by_header(session, _paths(batch)).values()
        ]
        if frames:
            rows = evolve(frames).withColumn("_ingestion_timestamp", F.current_timestamp())
            rows.write.mode("overwrite").parquet(f"{target}/_batch_id={batch_id}")

    return run_batches(_new_paths(spark, path, max_files, pattern), write, checkpoint)
