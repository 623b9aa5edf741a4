"""Sales lines: validate, quarantine, deduplicate, key, enrich, and merge increments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.joins import enrich
from stratalake.operators.merge import Insert, Update, merge
from stratalake.operators.quality import dedup_latest, normalize, surrogate_key, validate

# The domains and the text format of the source system.
CHANNELS = ("ecommerce", "tienda_fisica", "mayorista")
STATES = ("completada", "pendiente", "cancelada")
INGESTION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

SILVER_COLUMNS = (
    "venta_sk",
    "orden_id",
    "linea_id",
    "producto_id",
    "nombre_producto",
    "categoria",
    "marca",
    "cliente_id",
    "cantidad",
    "precio_unitario",
    "monto_total",
    "fecha_venta",
    "canal",
    "estado",
    "_join_status",
    "source_file",
    "ingestion_timestamp",
)


def validated(
    bronze: DataFrame, channels: Sequence[str] = CHANNELS, states: Sequence[str] = STATES
) -> DataFrame:
    """Normalized lines with their rejection reason; the first rule that fails names it."""
    clean = normalize(bronze, ["canal", "estado"]).withColumn("producto_id", F.trim("producto_id"))
    return validate(
        clean,
        [
            ("producto_id_nulo", F.col("producto_id").isNull()),
            ("monto_no_positivo", F.col("monto_total") <= 0),
            ("canal_invalido", ~F.col("canal").isin(*channels)),
            ("estado_invalido", ~F.col("estado").isin(*states)),
        ],
    )


def silver(valid: DataFrame, products: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One keyed, enriched line per natural key; the newest delivery wins."""
    parsed = valid.withColumns(
        {
            "fecha_venta": F.try_to_date("fecha_venta", "yyyy-MM-dd"),
            "ingestion_timestamp": F.try_to_timestamp("ingestion_timestamp", F.lit(INGESTION_FORMAT)),
        }
    )
    latest = dedup_latest(parsed, ["orden_id", "linea_id"], "ingestion_timestamp", tiebreak)
    keyed = surrogate_key(latest, ["orden_id", "linea_id"], "venta_sk")
    enriched = enrich(keyed, products, "producto_id", ["nombre_producto", "categoria", "marca"])
    return enriched.select(*SILVER_COLUMNS).withColumn("silver_processed_at", F.current_timestamp())


def merge_increment(target: DataFrame, staging: DataFrame) -> DataFrame:
    """Update lines whose state changed, insert new ones; running it again changes nothing."""
    return merge(
        target,
        staging,
        ["venta_sk"],
        matched=[
            Update(
                {"estado": "s.estado", "silver_processed_at": "s.silver_processed_at"}, when="t.estado <> s.estado"
            )
        ],
        not_matched=[Insert()],
    )
