"""Sources, sinks, drift and layout."""

import uuid

from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.operators.drift import flatten, rescue, typed, with_audit
from stratalake.operators import layout
from stratalake.operators.layout import compact as compact_files
from stratalake.operators.layout import zorder as zorder_rows
from stratalake.operators.merge import insert_rows
from stratalake.sources.files import (
    read_csv,
    read_csv_lots,
    read_csv_strings,
    read_json,
    read_lots,
    read_parquet,
    with_source_file,
)
from stratalake.sources.storage import stored, work_dir
from stratalake.sources.tables import append_lot, write_parquet, write_table


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       o_orderstatus
FROM orders
""")
def csv_scan(spark, sf_dir):
    path = work_dir(spark, "csv")
    orders = table(spark, sf_dir, "orders")
    orders.select(
        "o_orderstatus", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"), "o_totalprice", "o_orderkey"
    ).write.option("header", True).csv(path)
    schema = "o_orderkey BIGINT, o_orderdate DATE, o_totalprice DECIMAL(18,2), o_orderstatus STRING"
    return read_csv(spark, path, schema, date_format="dd/MM/yyyy")


@query("""
SELECT o_orderkey, CAST(NULL AS VARCHAR) AS currency, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice
FROM orders
""")
def conform_missing(spark, sf_dir):
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.option(
        "header", True
    ).csv(path)
    schema = "o_orderkey BIGINT, currency STRING, o_orderstatus STRING, o_totalprice DECIMAL(18,2)"
    return read_csv(spark, path, schema)


def _write_nested_events(spark, sf_dir):
    path = work_dir(spark, "json")
    events = table(spark, sf_dir, "events")
    events.select(
        "event_id",
        "user_id",
        F.struct(
            F.col("event_type").alias("kind"),
            F.col("value").cast("decimal(18,2)").alias("value"),
            F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")).alias("props"),
        ).alias("reading"),
    ).write.json(path)
    return path


NESTED_EVENTS = """event_id BIGINT, user_id BIGINT,
reading STRUCT<kind: STRING, value: DECIMAL(18,2), props: STRUCT<k: INT>>"""


@query("""
SELECT event_id, user_id, event_type AS kind, CAST(value AS DECIMAL(18,2)) AS value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
""")
def json_scan(spark, sf_dir):
    df = read_json(spark, _write_nested_events(spark, sf_dir), NESTED_EVENTS)
    return df.select("event_id", "user_id", "reading.kind", "reading.value", "reading.props.k")


@query("""
SELECT event_id, user_id, event_type AS reading_kind, CAST(value AS DECIMAL(18,2)) AS reading_value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS reading_props_k
FROM events
""")
def json_flatten(spark, sf_dir):
    return flatten(read_json(spark, _write_nested_events(spark, sf_dir), NESTED_EVENTS))


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem WHERE l_discount >= 0.05
""")
def parquet_prune(spark, sf_dir):
    path = work_dir(spark, "parquet")
    write_parquet(table(spark, sf_dir, "lineitem"), path)
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"]
    return read_parquet(spark, path, columns).filter(F.col("l_discount") >= 0.05)


@query("""
SELECT c_mktsegment AS folder, count(*) AS row_count FROM customer GROUP BY c_mktsegment
""")
def source_file_counts(spark, sf_dir):
    path = work_dir(spark, "lots")
    write_parquet(table(spark, sf_dir, "customer"), path, partition_by=["c_mktsegment"])
    rows = with_source_file(spark.read.parquet(path), full_path=True)
    folder = F.regexp_extract("_source_file", "c_mktsegment=([^/]+)/", 1)
    return rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("row_count"))


@query("""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT -1, 'Supplier#staged-1', NULL, 150.5
UNION ALL SELECT -2, 'Supplier#staged-2', NULL, NULL
""")
def values_staging(spark, sf_dir):
    staged = spark.sql(
        "SELECT * FROM VALUES (-1L, 'Supplier#staged-1', 150.5D), (-2L, 'Supplier#staged-2', CAST(NULL AS DOUBLE)) "
        "AS t(s_suppkey, s_name, s_acctbal)"
    )
    return insert_rows(table(spark, sf_dir, "supplier"), staged)


@query("""
SELECT c_custkey, c_name, NULL AS c_class FROM customer WHERE c_acctbal <= 0
UNION ALL
SELECT c_custkey, c_name, CASE WHEN c_acctbal > 5000 THEN 'EXPRESS' ELSE 'NORMAL' END FROM customer WHERE c_acctbal > 0
""")
def schema_evolution(spark, sf_dir):
    path = work_dir(spark, "lots")
    customer = table(spark, sf_dir, "customer")
    lot1, lot2 = f"{path}/lot1", f"{path}/lot2"
    customer.filter("c_acctbal <= 0").select("c_custkey", "c_name").write.option("header", True).csv(lot1)
    customer.filter("c_acctbal > 0").select(
        "c_custkey", F.when(F.col("c_acctbal") > 5000, "EXPRESS").otherwise("NORMAL").alias("c_class"), "c_name"
    ).write.option("header", True).csv(lot2)
    return read_csv_lots(spark, [lot1, lot2], "c_custkey BIGINT, c_name STRING, c_class STRING")


@query("""
SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS c_acctbal,
       CASE WHEN c_acctbal > 0 THEN NULL ELSE 'n/a' END AS rescued_balance, c_mktsegment AS rescued_segment,
       true AS has_rescued
FROM customer
""")
def rescue_columns(spark, sf_dir):
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        "c_name",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
        .otherwise("n/a")
        .alias("c_acctbal"),
    ).write.option("header", True).csv(path)
    rows = rescue(read_csv_strings(spark, path), "c_custkey BIGINT, c_name STRING, c_acctbal DECIMAL(18,2)")
    return rows.select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        F.get_json_object("_rescued_data", "$.c_acctbal").alias("rescued_balance"),
        F.get_json_object("_rescued_data", "$.c_mktsegment").alias("rescued_segment"),
        F.col("_rescued_data").isNotNull().alias("has_rescued"),
    )


@query("""
SELECT o_orderkey, 'orders.parquet' AS source_file, 'erp' AS source_system, 'b-001' AS batch_id,
       true AS has_time, true AS has_date
FROM orders
""")
def audit_columns(spark, sf_dir):
    audited = with_audit(table(spark, sf_dir, "orders"), "erp", "b-001")
    return audited.select(
        "o_orderkey",
        "source_file",
        "source_system",
        "batch_id",
        F.col("ingestion_timestamp").isNotNull().alias("has_time"),
        F.col("ingestion_date").isNotNull().alias("has_date"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
       CAST(o_orderdate AS DATE) AS ordered_on, o_orderdate AS ordered_at,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority
FROM orders
""")
def typed_decimal(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered_on"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ordered_at"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
    )
    return typed(
        texts,
        {
            "amount": "decimal(18,2)",
            "ordered_on": "date:yyyy-MM-dd",
            "ordered_at": "timestamp_ntz:yyyy-MM-dd'T'HH:mm:ss'Z'",
            "priority": "int",
        },
    )


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderpriority, count(*) AS row_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders WHERE year(o_orderdate) = 1997 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY ALL
""")
def partitioned_sink(spark, sf_dir):
    path = work_dir(spark, "partitioned")
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    write_parquet(orders, path, partition_by=["order_year", "o_orderpriority"])
    pruned = spark.read.parquet(path).filter("order_year = 1997 AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
    return pruned.groupBy("order_year", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def widened_append(spark, sf_dir):
    path = work_dir(spark, "lots")
    orders = table(spark, sf_dir, "orders")
    append_lot(orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01'").select("o_orderkey"), path, "a")
    later = orders.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'")
    append_lot(later.select("o_orderkey", "o_orderpriority"), path, "b")
    return read_lots(spark, path).drop("_lot")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
""")
def compact(spark, sf_dir):
    small, packed = work_dir(spark, "small"), work_dir(spark, "packed")
    table(spark, sf_dir, "lineitem").repartition(24).write.parquet(small)
    compact_files(spark, small, packed)
    return spark.read.parquet(packed)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
""")
def zorder(spark, sf_dir):
    path = work_dir(spark, "zorder")
    clustered = zorder_rows(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate"], files=8)
    write_parquet(clustered, path)
    return spark.read.parquet(path)


@query("""
SELECT o_orderkey, o_totalprice, o_orderstatus, 'int' AS key_type, 'double' AS price_type FROM orders
""")
def csv_inferred(spark, sf_dir):
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.option("header", True).csv(path)
    found = read_csv(spark, path)
    types = {f.name: f.dataType.simpleString() for f in found.schema}
    return found.withColumns(
        {
            "o_orderkey": F.col("o_orderkey").cast("bigint"),
            "key_type": F.lit(types["o_orderkey"]),
            "price_type": F.lit(types["o_totalprice"]),
        }
    )


@query("""
SELECT 'PERMISSIVE' AS mode, o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price
FROM orders
UNION ALL
SELECT 'DROPMALFORMED', o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders WHERE o_orderstatus <> 'P'
""")
def csv_modes(spark, sf_dir):
    path = work_dir(spark, "csv")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    orders = table(spark, sf_dir, "orders")
    orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(price).alias("price")).write.option("header", True).csv(path)
    kept, dropped = (
        read_csv(spark, path, "o_orderkey BIGINT, price DECIMAL(18,2)", mode=mode).withColumn("mode", F.lit(mode))
        for mode in ("PERMISSIVE", "DROPMALFORMED")
    )
    return kept.unionByName(dropped)


@query("SELECT c_custkey, c_name || ' ñandú' AS c_name FROM customer")
def csv_encoding(spark, sf_dir):
    path = work_dir(spark, "csv")
    named = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" ñandú")).alias("c_name"))
    named.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return read_csv(spark, path, "c_custkey BIGINT, c_name STRING", encoding="ISO-8859-1")


@query("SELECT s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier")
def json_multiline(spark, sf_dir):
    path = work_dir(spark, "json")
    rows = F.struct("s_suppkey", "s_name", F.col("s_acctbal").cast("decimal(18,2)").alias("s_acctbal"))
    # One array per file, of at most a hundred rows.
    lots = table(spark, sf_dir, "supplier").groupBy(F.expr("s_suppkey div 100").alias("lot")).agg(F.to_json(F.collect_list(rows)).alias("value"))
    lots.write.partitionBy("lot").text(path)
    return read_json(spark, path, "s_suppkey BIGINT, s_name STRING, s_acctbal DECIMAL(18,2)", multiline=True).drop("lot")


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
       true AS refused
FROM orders
""")
def table_sink(spark, sf_dir):
    """Overwrite, an append that is refused for its new column, and the same append with merge_schema."""
    name = f"orders_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    later = orders.filter("o_orderstatus = 'F'").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    write_table(orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus"), name)
    try:
        write_table(later, name, "append")
        refused = False
    except ValueError:
        refused = True
    write_table(later, name, "append", merge_schema=True)
    rows = stored(spark.table(name), "table")
    spark.sql(f"DROP TABLE {name}")
    return rows.withColumn("refused", F.lit(refused))


@query("SELECT c_custkey, c_name, c_mktsegment, true AS external FROM customer")
def external_table(spark, sf_dir):
    """The files stay where they are when the table is dropped."""
    name, path = f"customer_{uuid.uuid4().hex}", work_dir(spark, "external")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_table(customer, name, partition_by=["c_mktsegment"], path=path)
    external = spark.catalog.getTable(name).tableType == "EXTERNAL"
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path).withColumn("external", F.lit(external))


@query("SELECT 6 AS num_files, true AS has_bytes, count(*) AS row_count FROM orders")
def table_detail(spark, sf_dir):
    path = work_dir(spark, "detail")
    table(spark, sf_dir, "orders").repartition(6).write.parquet(path)
    stored_rows = spark.read.parquet(path)
    detail = layout.table_detail(stored_rows).crossJoin(stored_rows.agg(F.count(F.lit(1)).alias("row_count")))  # one row each
    return detail.select(F.col("num_files").cast("int").alias("num_files"), (F.col("size_in_bytes") > 0).alias("has_bytes"), "row_count")


@query("""
WITH y AS (SELECT year(o_orderdate) AS y, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1)
SELECT 'o_orderdate' AS filtered, (SELECT count(*) FROM y) AS files, 1 AS touched
UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (low <= 400000 AND high >= 400000) FROM y
""")
def files_touched(spark, sf_dir):
    """One file a year: a day lies in one of them, a price in many."""
    path = work_dir(spark, "years")
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    orders.repartition("y").write.partitionBy("y").parquet(path)
    rows = spark.read.parquet(path)
    middle = orders.filter("y = 1995").agg(F.min("o_orderdate")).first()[0]
    found = [
        layout.files_touched(rows, column, value).withColumn("filtered", F.lit(column))
        for column, value in (("o_orderdate", middle), ("o_totalprice", 400000.0))
    ]
    return found[0].unionByName(found[1])


@query("""
SELECT 'l_partkey' AS filtered, true AS skips_more, count(*) AS found FROM lineitem WHERE l_partkey = 77
UNION ALL SELECT 'l_quantity', true, count(*) FROM lineitem WHERE l_quantity = 12
UNION ALL SELECT 'l_extendedprice', true, count(*) FROM lineitem WHERE l_extendedprice = 20000
""")
def zorder_files_touched(spark, sf_dir):
    """Rows by three filters, and whether 64 clustered files let each filter skip a larger share than 16 do."""
    values = {"l_partkey": 77, "l_quantity": 12.0, "l_extendedprice": 20000.0}
    lines = stored(table(spark, sf_dir, "lineitem").select(*values), "lines")
    layouts = []
    for files in (16, 64):
        path = work_dir(spark, "zorder")
        write_parquet(zorder_rows(lines, list(values), files=files), path)
        layouts.append(spark.read.parquet(path))
    out = None
    for column, value in values.items():
        few, many = (layout.files_touched(rows, column, value).first() for rows in layouts)
        skips_more = many["touched"] * few["files"] < few["touched"] * many["files"]
        found = layouts[1].filter(F.col(column) == value).agg(F.count(F.lit(1)).alias("found"))
        found = found.withColumns({"filtered": F.lit(column), "skips_more": F.lit(skips_more)})
        out = found if out is None else out.unionByName(found)
    return out


@query("""
SELECT l_returnflag, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 6 END AS files_before, 1 AS files_after,
       l_returnflag <> 'R' AS rewritten, count(*) AS row_count
FROM lineitem GROUP BY l_returnflag
""")
def compact_in_place(spark, sf_dir):
    """Two partitions of six small files and one of a single file, which is left alone."""
    path = work_dir(spark, "crowded")
    lines = table(spark, sf_dir, "lineitem")
    write_parquet(lines.filter("l_returnflag <> 'R'").repartition(6), path, partition_by=["l_returnflag"])
    write_parquet(lines.filter("l_returnflag = 'R'").coalesce(1), path, "append", partition_by=["l_returnflag"])
    before = stored(layout.folder_files(spark, path, 1), "files")
    rewritten = layout.compact_in_place(spark, path, ["l_returnflag"])
    flag = F.regexp_extract("folder", "=(.*)", 1).alias("l_returnflag")
    before = before.select(flag, F.col("files").cast("int").alias("files_before"), F.col("folder").isin(rewritten).alias("rewritten"))
    after = layout.folder_files(spark, path, 1).select(flag, F.col("files").cast("int").alias("files_after"))
    rows = spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"))
    return before.join(after, "l_returnflag").join(rows, "l_returnflag")
