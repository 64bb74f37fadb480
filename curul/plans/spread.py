"""Spreading rows of few bytes and much work over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """The same rows in as many partitions as a shuffle has, by the columns. For rows that are few bytes but costly to
    work on, which adaptive execution would gather into a task or two by their size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)
