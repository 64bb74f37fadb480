"""Orders of rows with the place of missing values stated and ties broken by a sequence, as columns to sort by.

Spark's sort isn't stable, so every order ends in a column that tells all rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nulls_last(c: Column, seq: str, descending: bool = False) -> list[Column]:
    """Ascending or descending, what is missing or couldn't be read last in both."""
    return [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(seq).asc()]


def missing_first(text: Column, seq: str) -> list[Column]:
    """By text, null and empty alike first."""
    return [F.coalesce(text, F.lit("")).asc(), F.col(seq).asc()]


def unread_first(c: Column, *then: Column) -> list[Column]:
    """A value that couldn't be read counts as the least."""
    return [c.asc_nulls_first(), *then]


def three_levels(first: Column, second: Column, third: Column, seq: str) -> list[Column]:
    """By the first, then two numbers of which a missing one counts as 0."""
    return [first.asc_nulls_first(), F.coalesce(second, F.lit(0)).asc(), F.coalesce(third, F.lit(0)).asc(), F.col(seq).asc()]


def reversed_input(seq: str) -> list[Column]:
    """Newest first turned into oldest first, or back."""
    return [F.col(seq).desc()]


def best_first(score: Column, *then: str) -> list[Column]:
    """Candidates by score, then by their own places, all descending."""
    return [score.desc_nulls_last(), *[F.col(c).desc() for c in then]]


def places(rows: DataFrame, part: list[str], orders: dict[str, list[Column]]) -> DataFrame:
    """Adds a column of places from 1 within the part for each order; one shuffle, since all share the part."""
    return rows.withColumns({name: F.row_number().over(Window.partitionBy(*part).orderBy(*order)) for name, order in orders.items()})


def group_to_list(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """(keys..., values): each group's values as a list in the given order; for groups that a row can hold."""
    got = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"])
    return rows.groupBy(*keys).agg(got.alias("values"))
