"""Structured Streaming jobs, run until caught up; the answer is what the sink holds."""

from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.catalogue.changes import _EVENTS, _SCD2, CDC, cdc_events
from stratalake.sources.files import read_lots
from stratalake.sources.storage import work_dir
from stratalake.streaming import cdc
from stratalake.streaming.files import run_append, stream_files
from stratalake.streaming.files import stream_evolving as evolving
from stratalake.streaming.files import stream_rescued as rescued
from stratalake.streaming.silver import stream_silver as to_silver


@query("SELECT event_id, ts, user_id, event_type, value, 'events.parquet' AS source_file FROM events")
def stream_ingest(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = stream_files(spark, sf_dir, "parquet", schema, pathGlobFilter="events.parquet")
    target = work_dir(spark, "bronze")
    run_append(stream, target, work_dir(spark, "stream"))
    return spark.read.parquet(target).select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("_source_file").alias("source_file")
    )


@query("""
SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(12,2)) AS value, CAST(ts AS DATE) AS day
FROM events WHERE CAST(value AS DECIMAL(12,2)) > 10 AND CAST(ts AS DATE) <= DATE '2024-01-25'
""")
def stream_silver(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    bronze = stream_files(spark, sf_dir, "parquet", schema, pathGlobFilter="events.parquet")
    target = work_dir(spark, "silver")
    to_silver(
        bronze,
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "event_type": "event_type",
            "value": "try_cast(value AS DECIMAL(12,2))",
            "day": "to_date(ts)",
        },
        target,
        work_dir(spark, "stream"),
        drop={"positive": "value > 10", "not_future": "day <= DATE '2024-01-25'"},
        warn={"known_user": "user_id IS NOT NULL"},
    )
    return spark.read.parquet(target)


def _event_stream(spark, sf_dir):
    """The events as several files, one per micro-batch, in no particular order of time."""
    path = work_dir(spark, "landing")
    events = cdc_events(spark, sf_dir)
    events.repartition(3, "event_id").write.parquet(path)
    return stream_files(spark, path, "parquet", events.schema, max_files=1).drop("_source_file", "_ingestion_timestamp")


@query(f"WITH {_EVENTS} SELECT user_id, event_type, v FROM e WHERE rn = 1 AND event_type <> 'error'")
def stream_scd1(spark, sf_dir):
    log = work_dir(spark, "scd1")
    cdc.stream_scd1(_event_stream(spark, sf_dir), **CDC, log=log, checkpoint=work_dir(spark, "stream"), tiebreak=["event_id"])
    return cdc.read_scd1(spark, log, ["user_id"], ["ts", "event_id"], ["event_id"])


@query(f"WITH {_EVENTS} SELECT user_id, event_type, v FROM e WHERE rn = 1 AND event_type <> 'error'")
def stream_scd1_stored(spark, sf_dir):
    """The stored table; its first buckets are split as micro-batches arrive."""
    target = work_dir(spark, "scd1-table")
    cdc.stream_scd1_stored(
        _event_stream(spark, sf_dir), **CDC, target=target, checkpoint=work_dir(spark, "stream"),
        tiebreak=["event_id"], buckets=2, rows_per_bucket=200,
    )
    return cdc.read_scd1_stored(spark, target, ["ts", "event_id"])


def _event_log(spark, sf_dir):
    log = work_dir(spark, "scd2")
    cdc.stream_scd2(_event_stream(spark, sf_dir), **CDC, log=log, checkpoint=work_dir(spark, "stream"), buckets=8)
    return log


@query(_SCD2)
def stream_scd2(spark, sf_dir):
    rows = cdc.read_scd2(spark, _event_log(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["event_id"])
    return rows.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


@query(_SCD2)
def stream_scd2_stored(spark, sf_dir):
    log, target, progress = _event_log(spark, sf_dir), work_dir(spark, "history"), work_dir(spark, "progress")
    cdc.refresh_scd2(spark, log, target, progress, ["user_id"], ["ts", "event_id"], ["event_id"])
    rows = spark.read.parquet(target).drop("_bucket")
    return rows.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


def _write_customer_lots(spark, sf_dir):
    path = work_dir(spark, "landing")
    customer = table(spark, sf_dir, "customer")
    customer.filter("c_acctbal <= 0").select("c_custkey", "c_name").write.option("header", True).csv(f"{path}/lot1")
    customer.filter("c_acctbal > 0").select("c_mktsegment", "c_custkey", "c_name").write.option("header", True).csv(
        f"{path}/lot2"
    )
    return path


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def stream_evolving(spark, sf_dir):
    path, target = _write_customer_lots(spark, sf_dir), work_dir(spark, "bronze")
    evolving(spark, path, target, work_dir(spark, "stream"), "c_custkey BIGINT, c_name STRING")
    return read_lots(spark, target).select("c_custkey", "c_name", "c_mktsegment")


@query("""
SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS rescued_segment FROM customer
""")
def stream_rescued(spark, sf_dir):
    path, target = _write_customer_lots(spark, sf_dir), work_dir(spark, "bronze")
    rescued(spark, path, "c_custkey BIGINT, c_name STRING", target, work_dir(spark, "stream"))
    return spark.read.parquet(target).select(
        "c_custkey", "c_name", F.get_json_object("_rescued_data", "$.c_mktsegment").alias("rescued_segment")
    )


@query("""
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END AS first_run FROM customer
""")
def stream_restart(spark, sf_dir):
    """Two runs on one checkpoint: the second reads only the files that came after the first."""
    lots, target, checkpoint = work_dir(spark, "lots"), work_dir(spark, "bronze"), work_dir(spark, "stream")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for first_run, remainder in ((1, 1), (0, 0)):
        lot = customer.filter(F.col("c_custkey") % 2 == remainder).withColumn("first_run", F.lit(first_run))
        lot.write.mode("append").parquet(lots)
        stream = stream_files(spark, lots, "parquet", "c_custkey BIGINT, c_name STRING, first_run INT")
        run_append(stream, target, checkpoint)
    return spark.read.parquet(target).select("c_custkey", "c_name", "first_run")
