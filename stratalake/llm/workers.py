"""Python workers find this package where the driver found it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def share_package(spark: SparkSession) -> None:
    """Put the package's folder on the workers' PYTHONPATH, for a driver started from elsewhere.

    On a cluster the package is installed on all machines or comes with --py-files; then this changes nothing.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
