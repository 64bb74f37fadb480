"""Reading a directory of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a directory that holds ``<name>.parquet`` files or folders."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
