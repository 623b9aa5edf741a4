"""Session for local runs, tests and the benchmark. On a cluster the caller brings one."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "stratalake", **conf: str) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        # A skewed join is split even where that costs one more shuffle further up.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
