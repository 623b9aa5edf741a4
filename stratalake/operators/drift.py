"""Schema drift: evolve, rescue, conform, typing, and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def evolve(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one frame is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame, schema: T.StructType, extra: str = "drop") -> DataFrame:
    """Exactly the declared columns, bound by name; a missing one is a typed NULL."""
    present = set(df.columns)
    columns = [
        (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    if extra == "keep":
        declared = {f.name for f in schema}
        columns += [F.col(f"`{c}`") for c in df.columns if c not in declared]
    return df.select(*columns)


def parse_as(value: Column, dtype: T.DataType | str) -> Column:
    """Text to a type, NULL where it does not parse.

    "date:<format>" and "timestamp:<format>" name the text format.
    """
    if isinstance(dtype, str) and ":" in dtype:
        kind, pattern = dtype.split(":", 1)
        if kind == "date":
            return F.try_to_date(value, pattern)
        return F.try_to_timestamp(value, F.lit(pattern)).cast(kind)
    return value.try_cast(dtype)


def typed(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Give text columns their type; a value that does not parse becomes NULL."""
    return df.withColumns({name: parse_as(F.col(name), dtype) for name, dtype in types.items()})


def rescue(
    df: DataFrame, schema: T.StructType | str, column: str = RESCUED, keep: Sequence[str] = ()
) -> DataFrame:
    """Bind text columns to a fixed schema without losing anything.

    Known fields that parse are typed. Fields outside the schema and values that
    do not parse are kept as one JSON object in `column`, NULL when there are
    none. Columns in `keep` are not fields of the file and pass through.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = {f.name: f.dataType for f in declared}
    fields = [c for c in df.columns if c not in keep]
    leftovers = []
    for name in fields:
        value = F.col(f"`{name}`").cast("string")
        if name in known:
            value = F.when(value.try_cast(known[name]).isNull(), value)
        leftovers.append(value.alias(name))
    # to_json leaves NULL fields out of the object.
    rescued = F.when(F.coalesce(*leftovers).isNotNull(), F.to_json(F.struct(*leftovers)))
    columns = [
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in declared
    ]
    return df.select(*columns, rescued.alias(column), *keep)


def with_audit(
    df: DataFrame,
    source_system: str,
    batch_id: str,
    source_file: str | None = None,
) -> DataFrame:
    """Ingestion time, file, system, batch and ingestion date.

    Without `source_file` the name is taken from the file scan `df` must then be.
    """
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_file": F.lit(source_file) if source_file else F.col("_metadata.file_name"),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
            "ingestion_date": F.current_date(),
        }
    )


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Nested struct fields as top-level columns: a.b becomes a_b."""

    def leaves(fields: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out: list[Column] = []
        for field in fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                out.append(F.col(quoted).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))
