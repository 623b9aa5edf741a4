"""Batch ingest of one file into the partitioned bronze table, with its log entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.drift import with_audit
from stratalake.operators.quality import log_ingestion
from stratalake.sources.files import read_csv
from stratalake.sources.storage import load_version, save_version

LOG = """batch_id STRING, file STRING, source_system STRING, rows_read BIGINT, status STRING,
started_at TIMESTAMP, finished_at TIMESTAMP, seconds DOUBLE, target STRING"""


def ingest_file(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    target: str,
    source_system: str,
    batch_id: str,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Append one file, strictly parsed, partitioned by ingestion date; returns its log entry.

    Rows are counted while they are written; the file is read once.
    """
    started = spark.range(1).select(F.current_timestamp().alias("t")).first()["t"]
    file_name = path.rstrip("/").rsplit("/", 1)[-1]
    rows = read_csv(spark, path, schema, mode="FAILFAST", date_format=date_format)
    seen = Observation("ingest")
    audited = with_audit(rows, source_system, batch_id, file_name).observe(seen, F.count(F.lit(1)).alias("n"))
    audited.write.mode("append").partitionBy("ingestion_date").parquet(target)
    return spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(file_name).alias("file"),
        F.lit(source_system).alias("source_system"),
        F.lit(seen.get["n"]).cast("bigint").alias("rows_read"),
        F.lit("COMPLETADO").alias("status"),
        F.lit(started).alias("started_at"),
        F.current_timestamp().alias("finished_at"),
        (F.current_timestamp().cast("double") - F.lit(started).cast("double")).alias("seconds"),
        F.lit(target).alias("target"),
    )


def record(spark: SparkSession, log_root: str, entry: DataFrame, version: int) -> DataFrame:
    """Upsert an entry into the ingestion log; a retry of the same batch and file adds no row."""
    log = load_version(spark, log_root)
    if log is None:
        log = spark.createDataFrame([], LOG)
    save_version(log_ingestion(log, entry), log_root, version)
    return load_version(spark, log_root, version)
