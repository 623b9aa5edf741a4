"""Small reports over the silver inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def region_channel(sales: DataFrame, cancelled: str = "Cancelado") -> DataFrame:
    return sales.groupBy("region", "canal").agg(
        F.count(F.lit(1)).alias("total_transacciones"),
        F.round(F.sum("monto_total"), 2).alias("ingresos_totales"),
        F.round(F.avg("descuento_pct"), 1).alias("descuento_promedio"),
        F.count_if(F.col("estado") == cancelled).alias("cancelaciones"),
    )


def low_stock(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("stock_actual") <= F.col("stock_minimo"))


def region_category_month(detail: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Sales per region, category and month; the catalogue's size decides the join."""
    gross = F.col("cantidad") * F.col("precio_unitario")
    return (
        detail.join(catalogue.select("producto_id", "categoria"), "producto_id")
        .groupBy("region", "categoria", F.date_trunc("month", F.col("fecha_venta").cast("date")).cast("date").alias("mes"))
        .agg(
            F.count(F.lit(1)).alias("num_ventas"),
            F.round(F.sum(gross), 2).alias("total_bruto"),
            F.round(F.sum(gross * (1 - F.col("descuento_pct") / 100)), 2).alias("total_neto"),
        )
    )


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return sales.groupBy("categoria").agg(F.round(F.sum(F.col("cantidad") * F.col("precio_unitario")), 2).alias("ingresos"))


def in_month(df: DataFrame, column: str, first_day: str) -> DataFrame:
    """One calendar month as a half-open range, which a file scan can push down."""
    start = F.lit(first_day).cast("date")
    return df.filter((F.col(column) >= start) & (F.col(column) < F.add_months(start, 1)))


def top_earner(employees: DataFrame, by: str = "salario") -> DataFrame:
    return employees.orderBy(F.col(by).desc()).limit(1)
