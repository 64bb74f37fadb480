"""Record-level rules that report what is doubtful."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, id_cols: list[str], rules: dict[str, Column]) -> DataFrame:
    """(id_cols..., rule): one row for each rule a record breaks; a rule that gives null isn't broken.

    One pass over the rows whatever the number of rules."""
    broken = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return rows.select(*id_cols, F.explode(broken).alias("rule"))


def stored_against_computed(rows: DataFrame, id_cols: list[str], checks: dict[str, tuple[Column, Column, float]]) -> DataFrame:
    """(id_cols..., field, stored, computed): stored values beyond the tolerance from the computed ones, or present where
    the other isn't."""
    items = [F.struct(F.lit(k).alias("field"), s.cast("double").alias("stored"), c.cast("double").alias("computed"), F.lit(t).alias("tolerance")) for k, (s, c, t) in checks.items()]
    r = rows.select(*id_cols, F.explode(F.array(*items)).alias("x")).select(*id_cols, "x.*")
    off = (F.col("stored").isNull() != F.col("computed").isNull()) | (F.abs(F.col("stored") - F.col("computed")) > F.col("tolerance"))
    return r.where(off).select(*id_cols, "field", "stored", "computed")


def missing_by_column(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing, rows): nulls of each column, in one pass."""
    one = rows.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"), F.col("__n").alias("rows")) for c in columns])).alias("r")).select("r.*")
