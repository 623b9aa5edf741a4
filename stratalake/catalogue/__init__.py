"""Every operator as a query over the driver tables, each with the SQL that defines its answer."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ("scans", "relational", "quality", "changes", "streams", "jobs")
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        _queries[function.__name__] = function
        _oracles[function.__name__] = sql
        return function

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in _MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return dict(_queries), dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
