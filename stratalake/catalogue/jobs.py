"""The end-to-end jobs over the driver tables, mapped to the jobs' input contracts."""

from pyspark.sql import functions as F

from stratalake.catalogue import query, table
from stratalake.operators.merge import Insert, Update, merge_partitions
from stratalake.plans import kpi, retail, reviews, sales
from stratalake.sources.storage import stored, work_dir
from stratalake.sources.tables import write_parquet

MONEY = "decimal(18,2)"


def money(name):
    return F.col(name).cast(MONEY)


# --- retail ----------------------------------------------------------------

_RETAIL = """
raw AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS fecha, CAST(l_suppkey AS VARCHAR) AS tienda_id,
               upper(trim(' ' || lower(o_orderpriority) || ' ')) AS categoria, CAST(l_quantity AS INTEGER) AS cantidad,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS precio_unit, CAST(l_discount AS DECIMAL(5,2)) AS rate,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 2000 AS DECIMAL(18,2)) AS total,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETADO' WHEN 'O' THEN 'PENDIENTE' ELSE 'DEVUELTO' END AS estado, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
clean AS (SELECT *, rate > 0 AS tiene_descuento, CAST(precio_unit * cantidad * rate AS DECIMAL(18,2)) AS monto_descuento
          FROM raw WHERE total > 0 AND estado <> 'DEVUELTO')
"""


def _retail_raw(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").drop("l_tax", "l_linestatus", "l_shipdate")
    state = F.when(F.col("o_orderstatus") == "F", " completado ").when(F.col("o_orderstatus") == "O", "Pendiente")
    raw = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("l_suppkey").cast("string").alias("tienda_id"),
        F.col("o_custkey").cast("string").alias("cliente_id"),
        F.col("l_partkey").cast("string").alias("producto"),
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")).alias("categoria"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        money("l_extendedprice").alias("precio_unit"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).alias("descuento_pct"),
        (money("l_extendedprice") - 2000).cast(MONEY).alias("total"),
        F.col("l_returnflag").alias("metodo_pago"),
        state.otherwise("devuelto").alias("estado"),
        "l_linenumber",
    )
    return retail.bronze(raw, "round-1", source_file="lineitem.parquet")


@query(f"""
WITH {_RETAIL}
SELECT order_id, CAST(l_linenumber AS INTEGER) AS l_linenumber, categoria, estado, total, tiene_descuento, monto_descuento FROM clean
""")
def silver_clean(spark, sf_dir):
    return retail.silver(_retail_raw(spark, sf_dir)).select(
        "order_id", "l_linenumber", "categoria", "estado", "total", "tiene_descuento", money("monto_descuento").alias("monto_descuento")
    )


@query(f"""
WITH {_RETAIL}
SELECT tienda_id, categoria, count(order_id) AS num_transacciones, CAST(sum(total) AS DECIMAL(28,2)) AS ingresos_total,
       CAST(CAST((2 * CAST(sum(total) * 100 AS HUGEINT) + count(total)) // (2 * count(total)) AS DOUBLE) / 100 AS DECIMAL(18,2)) AS ticket_promedio,
       CAST(sum(cantidad) AS BIGINT) AS unidades_vendidas, max(fecha) AS ultima_venta
FROM clean GROUP BY tienda_id, categoria
""")
def gold_store_category(spark, sf_dir):
    gold = retail.gold(retail.silver(_retail_raw(spark, sf_dir)))
    return gold.withColumns(
        {"ingresos_total": F.col("ingresos_total").cast("decimal(28,2)"), "ticket_promedio": money("ticket_promedio")}
    )


# --- sales lines -----------------------------------------------------------

_SALES = """
bronze AS (SELECT CAST(l_orderkey AS VARCHAR) AS orden_id, l_linenumber AS linea_id,
                  CASE WHEN l_tax < 0.08 THEN CAST(l_partkey AS VARCHAR) END AS producto_id, CAST(o_custkey AS VARCHAR) AS cliente_id,
                  CAST(l_quantity AS INTEGER) AS cantidad, CAST(l_extendedprice AS DECIMAL(18,2)) AS precio_unitario,
                  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 2000 AS DECIMAL(18,2)) AS monto_total,
                  CAST(o_orderdate AS DATE) AS fecha_venta,
                  CASE l_returnflag WHEN 'A' THEN 'ecommerce' WHEN 'N' THEN 'mayorista' ELSE 'feria' END AS canal,
                  CASE o_orderstatus WHEN 'F' THEN 'completada' WHEN 'O' THEN 'pendiente' ELSE 'cancelada' END AS estado,
                  l_shipdate AS ingestion_timestamp
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
v AS (SELECT * FROM bronze WHERE producto_id IS NOT NULL AND monto_total > 0 AND canal <> 'feria'),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY orden_id, linea_id
        ORDER BY ingestion_timestamp DESC, producto_id, cantidad, monto_total, canal) AS rn FROM v) q WHERE rn = 1),
p AS (SELECT CAST(p_partkey AS VARCHAR) AS producto_id, p_name, p_type, p_brand FROM part WHERE p_size <= 40),
silver AS (SELECT sha256(concat_ws('|', orden_id, CAST(linea_id AS VARCHAR))) AS venta_sk, d.*, p.p_name AS nombre_producto,
                  p.p_type AS categoria, p.p_brand AS marca, CASE WHEN p.producto_id IS NULL THEN 'unmatched' ELSE 'matched' END AS join_status
           FROM d LEFT JOIN p ON d.producto_id = p.producto_id)
"""


def _sales_bronze(spark, sf_dir):
    # Joined by the id that the lines go by from here on, so that they are not shuffled again to find their latest delivery.
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_id"), "o_custkey", "o_orderdate", "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("orden_id", F.col("l_orderkey").cast("string"))
    channel = F.when(F.col("l_returnflag") == "A", " Ecommerce ").when(F.col("l_returnflag") == "N", "MAYORISTA")
    state = F.when(F.col("o_orderstatus") == "F", "Completada").when(F.col("o_orderstatus") == "O", " pendiente")
    return lines.join(orders, F.col("orden_id") == F.col("o_id")).select(
        "orden_id",
        F.col("l_linenumber").alias("linea_id"),
        F.when(F.col("l_tax") < 0.08, F.concat(F.lit(" "), F.col("l_partkey").cast("string"))).alias("producto_id"),
        F.col("o_custkey").cast("string").alias("cliente_id"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        money("l_extendedprice").alias("precio_unitario"),
        (money("l_extendedprice") - 2000).cast(MONEY).alias("monto_total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha_venta"),
        channel.otherwise("feria").alias("canal"),
        state.otherwise("cancelada").alias("estado"),
        F.date_format("l_shipdate", sales.INGESTION_FORMAT).alias("ingestion_timestamp"),
        F.lit("lineitem.parquet").alias("source_file"),
    )


def _sales_silver(spark, sf_dir):
    validated = sales.validated(_sales_bronze(spark, sf_dir))
    products = table(spark, sf_dir, "part").filter("p_size <= 40").select(
        F.col("p_partkey").cast("string").alias("producto_id"),
        F.col("p_name").alias("nombre_producto"),
        F.col("p_type").alias("categoria"),
        F.col("p_brand").alias("marca"),
    )
    valid = validated.filter("rejection_reason IS NULL").drop("rejection_reason")
    return sales.silver(valid, products, ["producto_id", "cantidad", "monto_total", "canal"])


@query(f"""
WITH {_SALES}
SELECT venta_sk, orden_id, CAST(linea_id AS INTEGER) AS linea_id, producto_id, nombre_producto, categoria, marca, cliente_id, cantidad,
       monto_total, fecha_venta, canal, estado, join_status, ingestion_timestamp
FROM silver
""")
def silver_sales(spark, sf_dir):
    silver = _sales_silver(spark, sf_dir)
    return silver.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz")).select(
        "venta_sk",
        "orden_id",
        "linea_id",
        "producto_id",
        "nombre_producto",
        "categoria",
        "marca",
        "cliente_id",
        "cantidad",
        "monto_total",
        "fecha_venta",
        "canal",
        "estado",
        F.col("_join_status").alias("join_status"),
        "ingestion_timestamp",
    )


@query(f"""
WITH {_SALES}
SELECT venta_sk, CASE WHEN estado = 'pendiente' AND monto_total > 50000 THEN 'completada' ELSE estado END AS estado, monto_total FROM silver
UNION ALL
SELECT sha256(concat_ws('|', 'W' || orden_id, CAST(linea_id AS VARCHAR))), 'completada', monto_total
FROM silver WHERE estado = 'cancelada'
""")
def silver_sales_merged(spark, sf_dir):
    """A second batch settles large pending lines and brings rebooked lines under new keys."""
    silver = stored(_sales_silver(spark, sf_dir), "silver")
    settled = silver.filter("estado = 'pendiente' AND monto_total > 50000")
    rebooked = silver.filter("estado = 'cancelada'").withColumn("orden_id", F.concat(F.lit("W"), "orden_id"))
    rekeyed = rebooked.withColumn("venta_sk", F.sha2(F.concat_ws("|", "orden_id", F.col("linea_id").cast("string")), 256))
    staging = settled.unionByName(rekeyed).withColumn("estado", F.lit("completada"))
    return sales.merge_increment(silver, staging).select("venta_sk", "estado", "monto_total")


# --- gold KPIs -------------------------------------------------------------

_KPI_SILVER = """
silver AS (SELECT l_orderkey AS venta_id, CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
                  CAST(month(o_orderdate) AS INTEGER) AS mes, p_brand AS categoria, p_type AS subcategoria, r_name AS region, n_name AS pais,
                  o_orderpriority AS canal_venta, c_mktsegment AS segmento_cliente, CAST(l_quantity AS INTEGER) AS unidades,
                  CAST(p_retailprice AS DECIMAL(18,4)) AS precio_unitario, CAST(l_discount AS DECIMAL(5,4)) AS descuento_pct,
                  CAST(l_extendedprice AS DECIMAL(18,2)) AS monto_bruto,
                  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(18,2)) AS monto_neto,
                  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.25 AS DECIMAL(5,2)) AS DECIMAL(18,2)) AS margen_bruto,
                  o_custkey AS cliente_id, l_suppkey AS tienda_id
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
           JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def _kpi_aggregate(grain):
    # Averages in exact arithmetic: half up at the declared scale.
    return f"""
kpi AS (SELECT {grain}, count(DISTINCT venta_id) AS total_transacciones, CAST(sum(unidades) AS BIGINT) AS total_unidades,
               count(DISTINCT cliente_id) AS clientes_unicos, count(DISTINCT tienda_id) AS tiendas_activas,
               CAST(sum(monto_bruto) AS DECIMAL(18,2)) AS venta_bruta, CAST(sum(monto_neto) AS DECIMAL(18,2)) AS venta_neta,
               CAST(sum(margen_bruto) AS DECIMAL(18,2)) AS margen_bruto_total,
               CAST(CAST((2 * CAST(sum(precio_unitario) * 10000 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000
                    AS DECIMAL(18,4)) AS precio_promedio,
               CAST(CAST((2 * CAST(sum(descuento_pct) * 10000 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100
                    AS DECIMAL(5,2)) AS descuento_promedio_pct,
               CAST(CAST((20000 * CAST(sum(margen_bruto) * 100 AS HUGEINT) + CAST(sum(monto_bruto) * 100 AS HUGEINT))
                         // (2 * CAST(sum(monto_bruto) * 100 AS HUGEINT)) AS DOUBLE) / 100 AS DECIMAL(5,2)) AS margen_pct
        FROM silver GROUP BY {grain})
"""


def _kpi_silver(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    # Narrow rows are shuffled first, orders before they are lines, and the names of places come last, without a shuffle.
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    joined = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .drop("l_partkey", "p_partkey")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    gross = money("l_extendedprice")
    return joined.select(
        F.col("l_orderkey").alias("venta_id"),
        F.year("o_orderdate").alias("anio"),
        F.quarter("o_orderdate").alias("trimestre"),
        F.month("o_orderdate").alias("mes"),
        F.col("p_brand").alias("categoria"),
        F.col("p_type").alias("subcategoria"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("pais"),
        F.col("o_orderpriority").alias("canal_venta"),
        F.col("c_mktsegment").alias("segmento_cliente"),
        F.col("l_quantity").cast("int").alias("unidades"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("precio_unitario"),
        F.col("l_discount").cast("decimal(5,4)").alias("descuento_pct"),
        gross.alias("monto_bruto"),
        (gross * (1 - F.col("l_discount").cast("decimal(5,2)"))).cast(MONEY).alias("monto_neto"),
        (gross * F.lit("0.25").cast("decimal(5,2)")).cast(MONEY).alias("margen_bruto"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("l_suppkey").alias("tienda_id"),
    )


SHORT_GRAIN = ("anio", "trimestre", "mes", "categoria", "canal_venta")


@query(f"WITH {_KPI_SILVER}, {_kpi_aggregate(', '.join(SHORT_GRAIN))} SELECT * FROM kpi")
def gold_kpi(spark, sf_dir):
    return kpi.sales_kpi(_kpi_silver(spark, sf_dir), SHORT_GRAIN).drop("dw_updated_at")


@query(f"""
WITH {_KPI_SILVER}, {_kpi_aggregate(', '.join(SHORT_GRAIN))}
SELECT categoria, canal_venta, sum(venta_neta) AS total_venta_neta, CAST(sum(total_unidades) AS BIGINT) AS total_unidades
FROM kpi WHERE anio = 1996 AND mes BETWEEN 1 AND 3 AND categoria = 'Brand#2' GROUP BY categoria, canal_venta
""")
def gold_filtered(spark, sf_dir):
    gold = kpi.sales_kpi(_kpi_silver(spark, sf_dir), SHORT_GRAIN)
    selected = gold.filter((F.col("anio") == 1996) & F.col("mes").between(1, 3) & (F.col("categoria") == "Brand#2"))
    return selected.groupBy("categoria", "canal_venta").agg(
        F.sum("venta_neta").cast("decimal(38,2)").alias("total_venta_neta"), F.sum("total_unidades").alias("total_unidades")
    )


_SERIES = ", ".join(c for c in kpi.GRAIN if c not in ("trimestre", "mes"))
_ANALYTIC = f"""
{_KPI_SILVER}, {_kpi_aggregate(', '.join(kpi.GRAIN))},
w AS (SELECT *, CAST(sum(venta_neta) OVER (PARTITION BY region, anio ORDER BY mes RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                     AS DECIMAL(18,2)) AS venta_neta_ytd,
             lag(venta_neta, 1) OVER (PARTITION BY {_SERIES} ORDER BY mes) AS prev
      FROM kpi),
gold AS (SELECT *, CASE WHEN prev <> 0 THEN TRY_CAST(CAST(sign(venta_neta - prev) * (
                     (2 * abs(CAST((venta_neta - prev) * 100 AS HUGEINT)) * 10000 + CAST(prev * 100 AS HUGEINT))
                     // (2 * CAST(prev * 100 AS HUGEINT))) AS DOUBLE) / 100 AS DECIMAL(5,2)) END AS variacion_mes_pct
         FROM w)
"""
_BI = ", ".join(
    f"{spec if isinstance(spec, str) else spec[0]} AS {public}" for public, spec in kpi.BI_COLUMNS.items()
)


@query(f"WITH {_ANALYTIC} SELECT {_BI} FROM gold")
def bi_view(spark, sf_dir):
    gold = stored(kpi.sales_kpi(_kpi_silver(spark, sf_dir)), "gold")
    return kpi.bi_view(kpi.analytic(gold))


@query(f"""
WITH {_KPI_SILVER}, {_kpi_aggregate(', '.join(kpi.GRAIN))}
SELECT * REPLACE (CASE WHEN mes = 1 THEN CAST(venta_neta * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) ELSE venta_neta END AS venta_neta,
                  CASE WHEN mes = 1 THEN CAST(margen_bruto_total * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) ELSE margen_bruto_total END
                    AS margen_bruto_total)
FROM kpi
""")
def merge_kpi(spark, sf_dir):
    gold = stored(kpi.sales_kpi(_kpi_silver(spark, sf_dir)), "gold")
    factor = F.lit("1.05").cast("decimal(3,2)")
    recalculated = gold.filter("mes = 1").withColumns(
        {c: (F.col(c) * factor).cast(MONEY) for c in ("venta_neta", "margen_bruto_total")}
    )
    return kpi.merge_recalculated(gold, recalculated).drop("dw_updated_at")


@query(f"""
WITH {_KPI_SILVER}, {_kpi_aggregate(', '.join(kpi.GRAIN))}
SELECT * REPLACE (CASE WHEN mes = 1 AND anio = 1997 THEN CAST(venta_neta * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,2))
                       ELSE venta_neta END AS venta_neta)
FROM kpi
""")
def merge_kpi_partitions(spark, sf_dir):
    """The stored KPI table is partitioned by year and region; one year's partitions are rewritten."""
    path = work_dir(spark, "gold")
    gold = kpi.sales_kpi(_kpi_silver(spark, sf_dir)).drop("dw_updated_at")
    write_parquet(gold, path, partition_by=["anio", "region"])
    january = stored(spark.read.parquet(path).filter("mes = 1 AND anio = 1997"), "recalculated").withColumn(
        "venta_neta", (F.col("venta_neta") * F.lit("1.05").cast("decimal(3,2)")).cast(MONEY)
    )
    merge_partitions(
        spark,
        path,
        january,
        kpi.GRAIN,
        ["anio", "region"],
        matched=[Update({"venta_neta": "s.venta_neta"})],
        not_matched=[Insert()],
        null_safe=True,
    )
    return spark.read.parquet(path)


# --- reviews ---------------------------------------------------------------


@query("""
SELECT p_partkey AS business_id, p_name AS name, p_brand AS address, CASE WHEN p_size > 25 THEN 'free' END AS wifi,
       p_type AS noiselevel, CASE WHEN p_size > 10 THEN 'True' ELSE 'False' END AS dogsallowed, p_size AS stars,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id, CAST(l_shipdate AS DATE) AS date, l_returnflag AS text,
       CASE CAST(ceil(l_quantity / 10) AS BIGINT) WHEN 1 THEN 'very negative' WHEN 2 THEN 'negative'
            WHEN 3 THEN 'neutral' WHEN 4 THEN 'positive' WHEN 5 THEN 'very positive' END AS review_sentiment
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def review_feedback(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    business = part.select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("address"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("hours"),
        F.struct(
            F.when(F.col("p_size") > 25, "free").alias("WiFi"),
            F.col("p_type").alias("NoiseLevel"),
            F.when(F.col("p_size") > 10, "True").alias("DogsAllowed"),
            F.lit(None).cast("string").alias("Open24Hours"),
        ).alias("attributes"),
        F.lit(1).alias("is_open"),
        F.lit(0).alias("review_count"),
        F.col("p_size").alias("stars"),
    )
    lines = table(spark, sf_dir, "lineitem")
    review = lines.select(
        F.col("l_partkey").alias("business_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.lit(None).cast("string").alias("user_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_returnflag").alias("text"),
        F.ceil(F.col("l_quantity") / 10).alias("stars"),
    )
    joined = reviews.feedback(reviews.silver_business(business), reviews.silver_review(review))
    return joined.drop("open24hours", "is_open")
