"""Layered (bronze, silver, gold) data engineering operators on Apache Spark.

Every operator takes DataFrames and returns a DataFrame, so Catalyst plans the
whole pipeline; nothing here replaces a Spark component.
"""

__version__ = "0.1.0"
