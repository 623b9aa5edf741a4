"""Profiling, rules, quarantine, expectations, deduplication and logs."""

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.operators import quality
from stratalake.sources import tables
from stratalake.sources.storage import work_dir

# Rejection reasons are the first failing rule's name.
RULES = [
    ("key_null", "c_custkey IS NULL"),
    ("non_positive", "c_acctbal <= 0"),
    ("bad_segment", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"),
]
_REASON = """
CASE WHEN c_custkey IS NULL THEN 'key_null' WHEN c_acctbal <= 0 THEN 'non_positive'
     WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'bad_segment' END
"""
EXPECTATIONS = {
    "positive_balance": "c_acctbal > 0",
    "known_segment": "c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')",
    "name_not_null": "c_name IS NOT NULL",
}


@query("""
SELECT 'l_quantity' AS "column", count(l_quantity) AS "count", round(avg(l_quantity), 6) AS mean,
       round(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS "min", max(l_quantity) AS "max" FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev_samp(l_extendedprice), 6),
       min(l_extendedprice), max(l_extendedprice) FROM lineitem
UNION ALL
SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6),
       min(l_discount), max(l_discount) FROM lineitem
""")
def profile_describe(spark, sf_dir):
    profile = quality.describe(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return profile.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


@query("""
SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(quality) AS quality,
       count(*) - count(toxic) AS toxic
FROM documents LEFT JOIN labels USING (doc_id)
""")
def null_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return quality.null_counts(documents.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn
      FROM lineitem) q
WHERE rn = 1
""")
def dedup_latest(spark, sf_dir):
    tiebreak = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    latest = quality.dedup_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", tiebreak)
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


@query(f"""
SELECT reason, count(*) AS row_count FROM (SELECT {_REASON} AS reason FROM customer) q WHERE reason IS NOT NULL GROUP BY reason
""")
def quarantine_reasons(spark, sf_dir):
    validated = quality.validate(table(spark, sf_dir, "customer"), RULES, reason="reason")
    rejected = validated.filter(F.col("reason").isNotNull())
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"""
SELECT c_custkey, c_name, reason AS rejection_reason, CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantine' END AS side,
       CASE WHEN reason IS NOT NULL THEN 'b-001' END AS source_batch_id, reason IS NOT NULL AS has_time
FROM (SELECT *, {_REASON} AS reason FROM customer) q
""")
def quarantine_split(spark, sf_dir):
    valid, rejected = quality.split(quality.validate(table(spark, sf_dir, "customer"), RULES), "b-001")
    both = valid.withColumn("side", F.lit("valid")).unionByName(
        rejected.withColumn("side", F.lit("quarantine")), allowMissingColumns=True
    )
    return both.select(
        "c_custkey",
        "c_name",
        "rejection_reason",
        "side",
        "source_batch_id",
        F.col("rejection_timestamp").isNotNull().alias("has_time"),
    )


@query("""
SELECT 'positive_balance' AS expectation, count(*) FILTER (c_acctbal > 0) AS passed,
       count(*) - count(*) FILTER (c_acctbal > 0) AS failed FROM customer
UNION ALL
SELECT 'known_segment', count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')),
       count(*) - count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')) FROM customer
UNION ALL
SELECT 'name_not_null', count(c_name), count(*) - count(c_name) FROM customer
""")
def expect_metrics(spark, sf_dir):
    return quality.violation_counts(table(spark, sf_dir, "customer"), EXPECTATIONS)


@query("""
SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
""")
def expect_drop(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return quality.expect_or_drop(customer, EXPECTATIONS).drop("c_name")


@query("SELECT c_custkey, c_name FROM customer")
def expect_fail(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return quality.expect_or_fail(customer, {"name_not_null": "c_name IS NOT NULL"}).select("c_custkey", "c_name")


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_tax <= 0.02 OR l_quantity > 45 AS bad FROM lineitem)
SELECT 'b-001' AS batch_id, count(*) AS total_rows, count(*) FILTER (NOT bad) AS valid_rows,
       count(*) FILTER (bad) AS rejected_rows,
       count(*) FILTER (NOT bad) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM v WHERE NOT bad)) AS duplicates_removed,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM v WHERE NOT bad)) AS final_rows,
       round(count(*) FILTER (bad) * 100.0 / count(*), 2) AS rejected_pct
FROM v
""")
def batch_metrics(spark, sf_dir):
    rules = [("low_tax", "l_tax <= 0.02"), ("large", "l_quantity > 45")]
    validated = quality.validate(table(spark, sf_dir, "lineitem"), rules)
    metrics = quality.batch_metrics(validated, ["l_orderkey", "l_linenumber"], "b-001")
    return metrics.withColumn("rejected_pct", F.col("rejected_pct").cast("double"))


@query("""
SELECT 'b-001' AS batch_id, o_orderpriority AS file, count(*) AS rows_read, 'COMPLETADO' AS status FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT 'b-002', c_mktsegment, count(*), 'COMPLETADO' FROM customer GROUP BY c_mktsegment
""")
def ingestion_log(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    # The first attempt saw only part of the files; the retry of the same batch must not add rows.
    partial = orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    log = quality.ingestion_entry(partial, "b-001", "o_orderpriority", status="FALLIDO")
    log = quality.log_ingestion(log, quality.ingestion_entry(orders, "b-001", "o_orderpriority"))
    return quality.log_ingestion(log, quality.ingestion_entry(customer, "b-002", "c_mktsegment"))


@query("""
SELECT c_custkey, c_acctbal, (SELECT count(*) > 0 FROM customer WHERE c_acctbal <= 0) AS refused
FROM customer WHERE c_acctbal > 0
""")
def checked_write(spark, sf_dir):
    """Rows that pass are written; a later batch with a row that does not leaves nothing behind."""
    path = work_dir(spark, "checked")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    checks = {"positive": "c_acctbal > 0"}
    tables.checked_write(customer.filter("c_acctbal > 0"), checks, path, not_null=["c_custkey"])
    try:
        tables.checked_write(customer.filter("c_acctbal <= 0"), checks, path)
        refused = False
    except PySparkException as error:
        if "check violated: positive" not in str(error):
            raise
        refused = True
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


@query("""
SELECT 'l_orderkey' AS key, count(*) = count(DISTINCT l_orderkey) AS is_unique FROM lineitem
UNION ALL SELECT 'o_orderkey', count(*) = count(DISTINCT o_orderkey) FROM orders
""")
def assert_unique(spark, sf_dir):
    out = None
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        rows = table(spark, sf_dir, name)
        try:
            quality.assert_unique(rows, key)
            unique = True
        except ValueError:
            unique = False
        row = rows.agg(F.lit(key).alias("key"), F.lit(unique).alias("is_unique"))
        out = row if out is None else out.unionByName(row)
    return out


@query("""
SELECT c_mktsegment, count(*) AS row_count, (SELECT count(*) FROM customer WHERE NOT coalesce(c_acctbal > 0, false)) AS not_positive,
       (SELECT count(*) FROM customer WHERE NOT coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'), false)) AS unknown_segment
FROM customer GROUP BY c_mktsegment
""")
def expect_warn(spark, sf_dir):
    """All rows reach the sink; the violations are counted on their way there."""
    path = work_dir(spark, "expected")
    kept, seen = quality.expect(table(spark, sf_dir, "customer"), EXPECTATIONS, "customer_expectations")
    tables.write_parquet(kept, path)
    counts = seen.get
    rows = spark.read.parquet(path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("row_count"))
    return rows.withColumns(
        {
            "not_positive": F.lit(counts["positive_balance"]).cast("bigint"),
            "unknown_segment": F.lit(counts["known_segment"]).cast("bigint"),
        }
    )


@query("""
SELECT 'positive_balance' AS expectation, count(*) > 0 AS stopped FROM customer WHERE NOT coalesce(c_acctbal > 0, false)
UNION ALL SELECT 'name_not_null', count(*) > 0 FROM customer WHERE c_name IS NULL
""")
def expect_fail_stops(spark, sf_dir):
    """Whether a write under each expectation is stopped by a row that breaks it."""
    customer = table(spark, sf_dir, "customer")
    out = None
    for name in ("positive_balance", "name_not_null"):
        try:
            tables.write_parquet(quality.expect_or_fail(customer, {name: EXPECTATIONS[name]}), work_dir(spark, "expected"))
            stopped = False
        except PySparkException as error:
            if f"expectation violated: {name}" not in str(error):
                raise
            stopped = True
        row = customer.agg(F.lit(name).alias("expectation"), F.lit(stopped).alias("stopped"))
        out = row if out is None else out.unionByName(row)
    return out
