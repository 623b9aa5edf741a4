"""Gold sales KPIs: aggregate, window metrics, incremental merge, publication view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.columns import safe_ratio
from stratalake.operators.drift import typed
from stratalake.operators.merge import Insert, Update, merge
from stratalake.operators.metrics import (
    aggregate_with_distinct,
    with_percent_change,
    with_previous,
    with_ranks,
    with_running_total,
)
from stratalake.sources.tables import publish

# Grain, measures and public column names of the gold table.
GRAIN = ("anio", "trimestre", "mes", "categoria", "subcategoria", "region", "pais", "canal_venta", "segmento_cliente")

# Declared types of the amounts, which arrive as text.
AMOUNT_TYPES = {
    "precio_unitario": "decimal(18,4)",
    "descuento_pct": "decimal(5,4)",
    "monto_bruto": "decimal(18,2)",
    "monto_neto": "decimal(18,2)",
    "costo_unitario": "decimal(18,4)",
    "margen_bruto": "decimal(18,2)",
}

MEASURES = (
    "total_transacciones",
    "total_unidades",
    "clientes_unicos",
    "tiendas_activas",
    "venta_bruta",
    "venta_neta",
    "margen_bruto_total",
    "precio_promedio",
    "descuento_promedio_pct",
    "margen_pct",
)

MERGED = (
    "total_transacciones",
    "total_unidades",
    "clientes_unicos",
    "venta_bruta",
    "venta_neta",
    "margen_bruto_total",
    "precio_promedio",
    "descuento_promedio_pct",
    "margen_pct",
    "venta_neta_ytd",
    "variacion_mes_pct",
    "dw_updated_at",
)

BI_COLUMNS = {
    "Anio": "anio",
    "Trimestre": "trimestre",
    "Mes": "mes",
    "Categoria": "categoria",
    "Subcategoria": "subcategoria",
    "Region": "region",
    "Pais": "pais",
    "Canal_Venta": "canal_venta",
    "Segmento_Cliente": "segmento_cliente",
    "Total_Transacciones": "total_transacciones",
    "Total_Unidades": "total_unidades",
    "Clientes_Unicos": "clientes_unicos",
    "Tiendas_Activas": "tiendas_activas",
    "Venta_Bruta_USD": ("venta_bruta", "decimal(18,2)"),
    "Venta_Neta_USD": ("venta_neta", "decimal(18,2)"),
    "Margen_Bruto_USD": ("margen_bruto_total", "decimal(18,2)"),
    "Margen_Pct": ("margen_pct", "decimal(5,2)"),
    "Descuento_Promedio_Pct": ("descuento_promedio_pct", "decimal(5,2)"),
    "Venta_Neta_YTD_USD": ("venta_neta_ytd", "decimal(18,2)"),
    "Variacion_Mes_Pct": ("variacion_mes_pct", "decimal(5,2)"),
}


def typed_silver(raw: DataFrame) -> DataFrame:
    return typed(raw, AMOUNT_TYPES)


def sales_kpi(silver: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """KPIs per grain. Amounts are DECIMAL; ratios are guarded against a zero base.

    A group is a month's sales of one cell of a grain of many columns, so its size is not checked.
    """
    kpi = aggregate_with_distinct(
        silver,
        grain,
        [
            F.sum("unidades").alias("total_unidades"),
            F.sum("monto_bruto").cast("decimal(18,2)").alias("venta_bruta"),
            F.sum("monto_neto").cast("decimal(18,2)").alias("venta_neta"),
            F.sum("margen_bruto").cast("decimal(18,2)").alias("margen_bruto_total"),
            F.avg("precio_unitario").cast("decimal(18,4)").alias("precio_promedio"),
            (F.avg("descuento_pct") * 100).try_cast("decimal(5,2)").alias("descuento_promedio_pct"),
            safe_ratio(F.sum("margen_bruto"), F.sum("monto_bruto"), 100).try_cast("decimal(5,2)").alias("margen_pct"),
        ],
        {"total_transacciones": "venta_id", "clientes_unicos": "cliente_id", "tiendas_activas": "tienda_id"},
        max_rows_per_group=None,
    )
    return kpi.select(*grain, *MEASURES, F.current_timestamp().alias("dw_updated_at"))


def analytic(kpi: DataFrame) -> DataFrame:
    """Ranks within region and month, year to date, previous month and its change.

    Year to date runs over whole months of a region. The previous month is that
    of the same row of the grain, so both are well defined where many rows share
    a month. A series has one row per month, so its window needs no size check.
    The KPI table is read several times; give it as a stored table.
    """
    series = [c for c in GRAIN if c not in ("trimestre", "mes")]
    ranked = with_ranks(
        kpi, ["region", "anio", "mes"], "venta_neta", "rank_categoria_region_mes", "dense_rank_categoria"
    )
    summed = with_running_total(ranked, ["region", "anio"], "mes", "venta_neta", "venta_neta_ytd", max_steps_per_group=None)
    lagged = with_previous(summed, series, "mes", "venta_neta", "venta_neta_mes_anterior", None)
    return with_percent_change(lagged, "venta_neta", "venta_neta_mes_anterior", "variacion_mes_pct")


def merge_recalculated(gold: DataFrame, recalculated: DataFrame, on: Sequence[str] = GRAIN) -> DataFrame:
    """Replace the measures of recalculated rows and insert new ones.

    The key is the whole grain and null-safe; with a part of it, or with NULL
    dimensions under plain equality, rows would match twice or be inserted again.
    """
    measures = [c for c in MERGED if c in gold.columns]
    return merge(
        gold,
        recalculated,
        on,
        matched=[Update({c: f"s.{c}" for c in measures})],
        not_matched=[Insert()],
        null_safe=True,
    )


def bi_view(gold: DataFrame) -> DataFrame:
    return publish(gold, BI_COLUMNS)
