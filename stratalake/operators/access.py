"""Column masks and row filters; the caller's role is an explicit argument."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.columns import ColumnLike, is_true, mask_tail

PRIVILEGED = frozenset({"data-engineer"})


def mask_columns(
    df: DataFrame, columns: Sequence[str], role: str, privileged: Collection[str] = PRIVILEGED, keep: int = 4
) -> DataFrame:
    """A privileged role sees the values, any other one only their last characters."""
    if role in privileged:
        return df
    return df.withColumns({c: mask_tail(F.col(c), keep) for c in columns})


def filter_rows(
    df: DataFrame, visible: ColumnLike, role: str, privileged: Collection[str] = PRIVILEGED
) -> DataFrame:
    """A privileged role sees all rows, any other one those where `visible` is true."""
    return df if role in privileged else df.filter(is_true(visible))


def register_mask(
    spark: SparkSession, name: str = "mask_account", privileged: Collection[str] = PRIVILEGED, keep: int = 4
) -> None:
    """SQL function name(value, role) with the same rule as `mask_columns`."""
    roles = ", ".join(f"'{r}'" for r in sorted(privileged))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING, role STRING) RETURNS STRING "
        f"RETURN CASE WHEN role IN ({roles}) THEN value ELSE concat('****-****-****-', right(value, {keep})) END"
    )


def register_row_filter(
    spark: SparkSession, name: str, visible_value: str, privileged: Collection[str] = PRIVILEGED
) -> None:
    """SQL function name(value, role) -> BOOLEAN: true for rows the role may see."""
    roles = ", ".join(f"'{r}'" for r in sorted(privileged))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING, role STRING) RETURNS BOOLEAN "
        f"RETURN role IN ({roles}) OR value = '{visible_value}'"
    )
