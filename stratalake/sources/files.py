"""Batch scans of CSV, JSON and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.drift import conform, evolve

Schema = T.StructType | str


def as_schema(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def csv_header(spark: SparkSession, path: str | list[str], **options: str) -> list[str]:
    """Column names of a CSV file; reads its first line only."""
    return spark.read.options(header=True, **options).csv(path).columns


def _parse_all(df: DataFrame) -> DataFrame:
    # The CSV reader skips parsing for columns nobody asks for, so a bare count
    # would not notice malformed rows. A filter over every column keeps them read.
    lowest = -(2**63)
    return df.filter(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) >= F.lit(lowest))


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    mode: str = "PERMISSIVE",
    date_format: str | None = None,
    timestamp_format: str | None = None,
    encoding: str | None = None,
    extra: str = "drop",
    **options: str,
) -> DataFrame:
    """CSV with a header, bound to `schema` by column name.

    Spark binds an explicit schema by position; here the header is read first,
    every column gets its declared type, and a declared column that the file
    does not have is NULL. Files whose header differs from the first one raise
    (use `read_csv_lots` for those). Without a schema the types are inferred,
    which costs a second pass. `extra` says what happens to undeclared columns:
    "drop", or "keep" as strings.
    """
    if encoding:
        options["encoding"] = encoding
    if date_format:
        options["dateFormat"] = date_format
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    if schema is None:
        return spark.read.options(header=True, inferSchema=True, mode=mode, **options).csv(path)

    declared = as_schema(schema)
    types = {f.name: f.dataType for f in declared}
    header = csv_header(spark, path, **options)
    file_schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    df = spark.read.schema(file_schema).options(header=True, enforceSchema=False, mode=mode, **options).csv(path)
    if mode.upper() != "PERMISSIVE":
        df = _parse_all(df)
    return conform(df, declared, extra=extra)


def read_csv_strings(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """CSV under its own header, every field as text."""
    return spark.read.options(header=True, enforceSchema=False, **options).schema(
        T.StructType([T.StructField(c, T.StringType()) for c in csv_header(spark, path, **options)])
    ).csv(path)


def files_by_header(spark: SparkSession, paths: Sequence[str], **options: str) -> dict[tuple[str, ...], list[str]]:
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        groups.setdefault(tuple(csv_header(spark, path, **options)), []).append(path)
    return groups


def read_csv_lots(
    spark: SparkSession, paths: Sequence[str], schema: Schema | None = None, **options: str
) -> DataFrame:
    """CSV lots with different headers as one table.

    Lots are read per header, since one CSV scan binds all files by the first
    header, and then combined by name: a column new in a later lot is NULL in
    the earlier ones. Columns outside `schema` are text.
    """
    known = {f.name: f.dataType for f in as_schema(schema)} if schema is not None else {}
    frames = []
    for header, members in files_by_header(spark, paths, **options).items():
        lot = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
        frames.append(read_csv(spark, members, lot, **options))
    return evolve(frames)


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    multiline: bool = False,
    **options: str,
) -> DataFrame:
    """JSON lines, or with `multiline` one JSON array per file. Inferred without a schema."""
    reader = spark.read.options(multiLine=multiline, **options)
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_lots(spark: SparkSession, path: str) -> DataFrame:
    """All lots below `path`, columns merged over lots."""
    return spark.read.option("mergeSchema", True).parquet(path)


def with_source_file(df: DataFrame, name: str = "_source_file", full_path: bool = False) -> DataFrame:
    """Add the file each row came from. Apply it directly to a file scan."""
    field = "_metadata.file_path" if full_path else "_metadata.file_name"
    return df.withColumn(name, F.col(field))
