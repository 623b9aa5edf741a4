"""Retail transactions: raw -> clean -> store x category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.columns import is_true
from stratalake.operators.quality import normalize

# States that count as active.
ACTIVE_STATES = ("COMPLETADO", "PENDIENTE")


def bronze(raw: DataFrame, batch: str, source_file: str | None = None) -> DataFrame:
    return raw.withColumns(
        {
            "_ingestion_ts": F.current_timestamp(),
            "_source_file": F.lit(source_file) if source_file else F.col("_metadata.file_name"),
            "_batch_session": F.lit(batch),
        }
    )


def silver(bronze: DataFrame, states: tuple[str, ...] = ACTIVE_STATES) -> DataFrame:
    """Keyed rows with a positive total, normalized text, and an active state."""
    usable = bronze.filter(F.col("order_id").isNotNull() & (F.col("total") > 0))
    clean = normalize(usable, ["categoria", "estado", "metodo_pago"], case="upper").filter(
        F.col("estado").isin(*states)
    )
    discount = F.col("precio_unit") * F.col("cantidad") * F.col("descuento_pct") / 100
    return (
        clean.withColumns(
            {"tiene_descuento": is_true(F.col("descuento_pct") > 0), "monto_descuento": F.round(discount, 2)}
        )
        .drop("_source_file", "_batch_session")
        .withColumnRenamed("_ingestion_ts", "bronze_ts")
    )


def gold(silver: DataFrame) -> DataFrame:
    return silver.groupBy("tienda_id", "categoria").agg(
        F.count("order_id").alias("num_transacciones"),
        F.round(F.sum("total"), 2).alias("ingresos_total"),
        F.round(F.avg("total"), 2).alias("ticket_promedio"),
        F.sum("cantidad").alias("unidades_vendidas"),
        F.max("fecha").alias("ultima_venta"),
    )
