"""Table and view sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.drift import conform
from stratalake.operators.quality import guard, violation_counts


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Parquet sink. With partitions, overwrite replaces only the partitions present in `df`."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_lot(df: DataFrame, path: str, lot: str) -> None:
    """Append one lot that may carry new columns; read back with `read_lots`.

    Each lot has its own folder, so writing the same lot again replaces it.
    """
    df.write.mode("overwrite").parquet(f"{path}/_lot={lot}")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    replace_schema: bool = False,
    merge_schema: bool = False,
) -> None:
    """Catalog table sink.

    `path` makes the table external. `replace_schema` lets an overwrite change
    the columns. `merge_schema` lets an append bring new columns (older rows read
    NULL) or leave some out, and an overwrite add columns. Without either, columns that are new, missing or of
    another type are refused; the order of columns does not matter.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and not replace_schema:
        table = spark.table(name)
        added = [f for f in df.schema if f.name not in table.columns]
        if added and not merge_schema:
            raise ValueError(f"columns not in {name}: {[f.name for f in added]}")
        if not (mode == "append" and merge_schema):
            missing = [c for c in table.columns if c not in df.columns]
            if missing:
                raise ValueError(f"columns of {name} that are not given: {missing}")
            types = {f.name: f.dataType for f in table.schema}
            retyped = [f"{f.name} {types[f.name].simpleString()} to {f.dataType.simpleString()}" for f in df.schema if f.name in types and f.dataType != types[f.name]]
            if retyped:
                raise ValueError(f"columns of {name} would change type: {retyped}")
        if added and mode == "append":
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            table = spark.table(name)
        if mode == "append" and merge_schema:
            df = conform(df, table.schema)
    if exists and mode == "append":
        # insertInto is by position; the select makes it by name.
        df.select(*spark.table(name).columns).write.insertInto(name)
        return
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def checked_write(
    df: DataFrame,
    checks: Mapping[str, Column | str],
    path: str,
    mode: str = "append",
    not_null: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Write only if every row satisfies every check; otherwise nothing is written.

    A check that evaluates to NULL passes (as a CHECK constraint does); columns
    in `not_null` must not be NULL. The guard is part of the plan, so a bad row
    fails the job before its commit. An overwrite drops the old files before the
    job runs, so there the violations are counted first.
    """
    rules = {name: F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(True)) for name, c in checks.items()}
    rules.update({f"{c} NOT NULL": F.col(c).isNotNull() for c in not_null})
    if mode == "overwrite" and rules:
        counted = {r["expectation"]: r["failed"] for r in violation_counts(df, rules).collect()}
        broken = {name: n for name, n in counted.items() if n}
        if broken:
            raise ValueError(f"rows violate checks: {broken}")
    for name, rule in rules.items():
        df = guard(df, rule, f"check violated: {name}")
    write_parquet(df, path, mode, partition_by)


def register(df: DataFrame, name: str, global_: bool = False) -> None:
    if global_:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)


def publish(df: DataFrame, mapping: Mapping[str, str | tuple[str, str]]) -> DataFrame:
    """Projection for consumers: {public name: column or (column, type)}; the rest stays hidden.

    A value that does not fit the declared type is published as NULL.
    """
    columns = []
    for public, spec in mapping.items():
        column, dtype = (spec, None) if isinstance(spec, str) else spec
        value = F.col(column)
        columns.append((value.try_cast(dtype) if dtype else value).alias(public))
    return df.select(*columns)
