"""Projection, filters, joins, aggregates, windows, sorts and scalar functions."""

from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.functions.columns import clean_text, key_hash
from stratalake.operators import access
from stratalake.operators.joins import dropped_between, enrich
from stratalake.operators.joins import join_sort_merge as sort_merge
from stratalake.operators.metrics import top_n_per_group, with_percent_change, with_previous, with_ranks, with_running_total
from stratalake.operators.ordering import balanced_buckets
from stratalake.operators.quality import layer_delta as count_delta
from stratalake.plans import reports
from stratalake.plans.reviews import sentiment
from stratalake.sources.storage import stored
from stratalake.sources.tables import register

MONEY = "decimal(18,2)"


def money(name):
    return F.col(name).cast(MONEY)


# --- projection and filter -------------------------------------------------


@query("""
SELECT c_custkey, upper(c_name) AS name_upper, CAST(c_acctbal AS DECIMAL(18,2)) * 12 AS yearly,
       c_acctbal > 0 AS in_credit, c_nationkey + 5 AS nation_plus
FROM customer
""")
def with_columns(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .withColumns(
            {
                "name_upper": F.upper("c_name"),
                "yearly": money("c_acctbal") * 12,
                "in_credit": F.col("c_acctbal") > 0,
                "nation_plus": F.col("c_nationkey") + 5,
            }
        )
        .select("c_custkey", "name_upper", "yearly", "in_credit", "nation_plus")
    )


@query("""
SELECT p_partkey, p_name, p_size AS stock_actual, CAST(floor(p_retailprice / 50) AS BIGINT) AS stock_minimo
FROM part WHERE p_size <= floor(p_retailprice / 50)
""")
def low_stock(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        F.col("p_size").alias("stock_actual"),
        F.floor(F.col("p_retailprice") / 50).alias("stock_minimo"),
    )
    return reports.low_stock(part)


@query("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-02-01' AND o_orderdate < TIMESTAMP '1996-03-01'
""")
def month_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return reports.in_month(orders, "o_orderdate", "1996-02-01")


@query("""
SELECT l_orderkey, l_linenumber, CAST(ceil(l_quantity / 10) AS BIGINT) AS stars,
       CASE CAST(ceil(l_quantity / 10) AS BIGINT) WHEN 1 THEN 'very negative' WHEN 2 THEN 'negative'
            WHEN 3 THEN 'neutral' WHEN 4 THEN 'positive' WHEN 5 THEN 'very positive' END AS review_sentiment,
       CASE WHEN nullif(l_returnflag, 'N') IS NULL THEN 'False' ELSE l_returnflag END AS flag
FROM lineitem
""")
def rating_bucket(spark, sf_dir):
    stars = F.ceil(F.col("l_quantity") / 10)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        stars.alias("stars"),
        sentiment(stars).alias("review_sentiment"),
        F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("False")).alias("flag"),
    )


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()


# --- joins -----------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_type,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2)) AS net
FROM lineitem JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l_partkey = p_partkey
""")
def join_inner(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter("p_size <= 25").select("p_partkey", "p_brand", "p_type")
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    net = (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(5,2)"))).cast(MONEY)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "p_type", net.alias("net"))


@query("""
SELECT o_custkey, c_mktsegment, o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_sort_merge(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return sort_merge(orders, customer, "o_custkey").select("o_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, p_brand,
       CASE WHEN p_partkey IS NULL THEN 'unmatched' ELSE 'matched' END AS join_status
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l_partkey = p_partkey
""")
def enrich_left(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").filter("p_size <= 25").withColumnRenamed("p_partkey", "l_partkey")
    return enrich(lines, part, "l_partkey", ["p_brand"], status="join_status").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "join_status"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
""")
def anti_dropped(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = table(spark, sf_dir, "part").filter("p_size <= 25").withColumnRenamed("p_partkey", "l_partkey")
    return dropped_between(lines, part, "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
SELECT o_orderpriority AS region, p_brand AS categoria, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
       count(*) AS num_ventas,
       CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_bruto,
       CAST(sum(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(18,2))
                * (1 - CAST(l_discount AS DECIMAL(5,2)))) AS DECIMAL(28,2)) AS total_neto
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY ALL
""")
def region_category_month(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("producto_id"), F.col("p_brand").alias("categoria"), money("p_retailprice").alias("price")
    )
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    detail = lines.join(part.drop("categoria"), F.col("l_partkey") == F.col("producto_id")).select(
        "producto_id",
        F.col("o_orderpriority").alias("region"),
        F.col("o_orderdate").alias("fecha_venta"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("price").alias("precio_unitario"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).alias("descuento_pct"),
    )
    result = reports.region_category_month(detail, part)
    return result.withColumns({c: F.col(c).cast("decimal(28,2)") for c in ("total_bruto", "total_neto")})


# --- aggregates ------------------------------------------------------------


@query("""
SELECT lang, count(*) AS documents, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang
""")
def profile_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.count("quality").alias("labelled"))


@query("""
SELECT min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, count(*) AS row_count,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
FROM orders
""")
def date_bounds(spark, sf_dir):
    return table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first_day"),
        F.max("o_orderdate").alias("last_day"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("total"),
    )


@query("""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY o_custkey
""")
def sum_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).cast("decimal(28,2)").alias("total"))


@query("""
SELECT o_orderstatus, o_orderpriority, count(*) AS row_count FROM orders GROUP BY o_orderstatus, o_orderpriority
""")
def counts_by_status(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("row_count"))


@query("""
SELECT (SELECT count(*) FROM lineitem) AS rows_before,
       (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25) AS rows_after,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25) AS dropped
""")
def layer_delta(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey")
    part = table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("l_partkey"))
    return count_delta(lines, lines.join(part, "l_partkey", "left_semi"))


@query("""
SELECT r_name AS region, o_orderpriority AS canal, count(*) AS total_transacciones,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS ingresos_totales,
       round(avg(l_discount * 100), 1) AS descuento_promedio,
       CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS cancelaciones
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, o_orderpriority
""")
def sql_view_region_channel(spark, sf_dir):
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        register(table(spark, sf_dir, name), f"report_{name}")
    sales = spark.sql("""
        SELECT r_name AS region, o_orderpriority AS canal, CAST(l_extendedprice AS DECIMAL(18,2)) AS monto_total,
               l_discount * 100 AS descuento_pct, o_orderstatus AS estado
        FROM report_lineitem JOIN report_orders ON l_orderkey = o_orderkey
        JOIN report_customer ON o_custkey = c_custkey
        JOIN report_nation ON c_nationkey = n_nationkey JOIN report_region ON n_regionkey = r_regionkey
    """)
    register(sales, "report_sales", global_=True)
    report = reports.region_channel(spark.table("global_temp.report_sales"), cancelled="P")
    return report.withColumn("ingresos_totales", F.col("ingresos_totales").cast("decimal(28,2)"))


# --- windows, sorts, set operations ----------------------------------------

_MONTHLY = """
g AS (SELECT p_brand AS brand, o_orderpriority AS pr, CAST(year(o_orderdate) AS BIGINT) AS y,
             CAST(month(o_orderdate) AS BIGINT) AS mo,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2)))) AS DECIMAL(18,2)) AS v
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4)
"""


def monthly_sales(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    net = money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(5,2)"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.col("p_brand").alias("brand"),
            F.col("o_orderpriority").alias("pr"),
            F.year("o_orderdate").cast("bigint").alias("y"),
            F.month("o_orderdate").cast("bigint").alias("mo"),
        )
        .agg(F.sum(net).cast(MONEY).alias("v"))
    )


@query(f"""
WITH {_MONTHLY},
w AS (
  SELECT brand, pr, y, mo, v, CAST(rank() OVER (PARTITION BY pr, y, mo ORDER BY v DESC) AS BIGINT) AS rk,
         CAST(dense_rank() OVER (PARTITION BY pr, y, mo ORDER BY v DESC) AS BIGINT) AS drk,
         CAST(sum(v) OVER (PARTITION BY brand, pr, y ORDER BY mo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS DECIMAL(28,2)) AS ytd,
         lag(v, 1) OVER (PARTITION BY brand, pr, y ORDER BY mo) AS prev
  FROM g),
c AS (SELECT *, CAST((v - prev) * 100 AS HUGEINT) AS n, CAST(prev * 100 AS HUGEINT) AS d FROM w)
SELECT brand, pr, y, mo, v, rk, drk, ytd, prev,
       -- percent change in exact arithmetic, half up
       CASE WHEN d <> 0 THEN CAST(CAST(sign(n) * ((2 * abs(n) * 10000 + d) // (2 * d)) AS DOUBLE) / 100 AS DECIMAL(18,2)) END
         AS change_pct
FROM c
""")
def gold_windows(spark, sf_dir):
    g = stored(monthly_sales(spark, sf_dir), "gold")
    series = ["brand", "pr", "y"]
    df = with_ranks(g, ["pr", "y", "mo"], "v", "rk", "drk")
    df = with_running_total(df, series, "mo", "v", "ytd", "decimal(28,2)", max_steps_per_group=None)
    df = with_percent_change(with_previous(df, series, "mo", "v", "prev", None), "v", "prev", "change_pct")
    return df.withColumns(
        {
            "rk": F.col("rk").cast("bigint"),
            "drk": F.col("drk").cast("bigint"),
            "change_pct": F.col("change_pct").cast(MONEY),
        }
    )


_RANKS = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
       CAST(rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS BIGINT) AS rk,
       CAST(dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS BIGINT) AS drk
FROM lineitem
"""


@query(_RANKS)
def ranks_hot_groups(spark, sf_dir):
    """Three groups, each about a third of the table, with every group treated as too large for one task."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    ranked = with_ranks(lines, ["l_returnflag"], "l_quantity", "rk", "drk", max_rows_per_group=0)
    return ranked.withColumns({"rk": F.col("rk").cast("bigint"), "drk": F.col("drk").cast("bigint")})


@query("""
SELECT o_orderstatus, o_orderdate, o_orderkey,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS running
FROM orders
""")
def running_total_hot(spark, sf_dir):
    """Three groups that hold the whole table, with every group treated as too long for one task."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey", money("o_totalprice").alias("price"))
    totals = with_running_total(orders, ["o_orderstatus"], "o_orderdate", "price", "running", "decimal(28,2)", max_steps_per_group=0)
    return totals.drop("price")


@query("""
SELECT 8 AS partitions, count(*) AS row_count, true AS balanced FROM orders
""")
def partition_sizes(spark, sf_dir):
    """Rows per partition of a repartitioned table, by their partition id."""
    spread = table(spark, sf_dir, "orders").select("o_orderkey").repartition(8)
    sizes = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).cast("int").alias("partitions"),
        F.sum("n").alias("row_count"),
        (F.max("n") <= F.min("n") + 16).alias("balanced"),
    )


@query("""
SELECT * FROM (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS y, o_orderstatus, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         rank() OVER (PARTITION BY year(o_orderdate), o_orderstatus ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC) AS rk
  FROM orders) q
WHERE rk <= 3
""")
def topn_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("y"), "o_orderstatus", "o_orderkey", money("o_totalprice").alias("price")
    )
    top = top_n_per_group(orders, ["y", "o_orderstatus"], "price", 3, "rk")
    return top.withColumn("rk", F.col("rk").cast("bigint"))


@query("""
SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS bucket FROM orders
""")
def ntile_buckets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return balanced_buckets(orders, ["o_orderdate", "o_orderkey"], 7).drop("o_orderdate")


@query("""
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 50
""")
def topk_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderdate", "o_orderkey").limit(50)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def top1(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customer.orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(1)


@query("""
SELECT 'CUSTOMER' AS level, c_nationkey AS nationkey, c_name AS name FROM customer
UNION ALL SELECT 'SUPPLIER', s_nationkey, s_name FROM supplier
""")
def union_levels(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        F.lit("CUSTOMER").alias("level"), F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.lit("SUPPLIER").alias("level"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey")
    )
    return customer.unionByName(supplier)


# --- scalar functions ------------------------------------------------------


@query("""
SELECT c_custkey, trim(lower('  ' || c_mktsegment || ' ')) AS low, trim(upper('  ' || c_name || ' ')) AS up,
       concat_ws('-', c_name, c_mktsegment) AS joined, right(c_name, 4) AS tail
FROM customer
""")
def string_norm(spark, sf_dir):
    def padded(c):
        return F.concat(F.lit("  "), F.col(c), F.lit(" "))

    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        clean_text(padded("c_mktsegment")).alias("low"),
        clean_text(padded("c_name"), "upper").alias("up"),
        F.concat_ws("-", "c_name", "c_mktsegment").alias("joined"),
        F.right("c_name", F.lit(4)).alias("tail"),
    )


@query("""
SELECT l_orderkey, l_linenumber,
       sha256(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS line_sk
FROM lineitem
""")
def surrogate_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", key_hash(["l_orderkey", "l_linenumber"]).alias("line_sk")
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY AS DATE) AS day_before,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, CAST(year(o_orderdate) AS BIGINT) AS y,
       CAST(quarter(o_orderdate) AS BIGINT) AS q, o_orderdate >= TIMESTAMP '1997-01-01' AS recent,
       CAST(NULL AS DATE) AS unparsable
FROM orders
""")
def date_functions(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    day = F.try_to_date(text, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.date_sub(day, 1).alias("day_before"),
        F.date_trunc("month", day).cast("date").alias("month_start"),
        F.year(day).cast("bigint").alias("y"),
        F.quarter(day).cast("bigint").alias("q"),
        (F.try_to_timestamp(text, F.lit("yyyy-MM-dd")) >= F.lit("1997-01-01").cast("timestamp")).alias("recent"),
        F.try_to_date(F.col("o_orderstatus"), "yyyy-MM-dd").alias("unparsable"),
    )


# --- protection ------------------------------------------------------------


@query("""
SELECT c_custkey, '****-****-****-' || right(c_name, 4) AS c_name, c_name AS seen_by_engineer FROM customer
""")
def mask_account(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_name").alias("seen_by_engineer"))
    masked = access.mask_columns(customer, ["c_name"], role="analyst")
    return access.mask_columns(masked, ["seen_by_engineer"], role="data-engineer")


@query("""
SELECT c_custkey, '****-****-****-' || right(c_name, 4) AS for_analyst, c_name AS for_engineer FROM customer
""")
def mask_sql_udf(spark, sf_dir):
    access.register_mask(spark, "mask_account")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.expr("mask_account(c_name, 'analyst')").alias("for_analyst"),
        F.expr("mask_account(c_name, 'data-engineer')").alias("for_engineer"),
    )


@query("""
SELECT c_custkey, c_mktsegment, c_mktsegment = 'BUILDING' AS for_analyst, true AS for_engineer FROM customer
""")
def row_filter_sql_udf(spark, sf_dir):
    access.register_row_filter(spark, "sees_segment", "BUILDING")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        F.expr("sees_segment(c_mktsegment, 'analyst')").alias("for_analyst"),
        F.expr("sees_segment(c_mktsegment, 'data-engineer')").alias("for_engineer"),
    )


@query("""
SELECT 'analyst' AS role, n_name, count(*) AS accounts, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7' GROUP BY n_name
UNION ALL
SELECT 'data-engineer', n_name, count(*), CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(28,2))
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def row_filter(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    accounts = table(spark, sf_dir, "customer").join(nation, "c_nationkey")

    def seen_by(role):
        rows = access.filter_rows(accounts, "n_name = 'NATION_7'", role)
        return rows.groupBy(F.lit(role).alias("role"), "n_name").agg(
            F.count(F.lit(1)).alias("accounts"), F.sum(money("c_acctbal")).cast("decimal(28,2)").alias("balance")
        )

    return seen_by("analyst").unionByName(seen_by("data-engineer"))
