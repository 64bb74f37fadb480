"""A reference list as an expression over a column of typed values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curul.functions.lexicon import Catalog
from curul.functions.unicode_text import is_missing

# Other names of having no party.
NO_PARTY = ("Independiente", "Candidatura Independiente", "Indep")


def list_of(reference: DataFrame, id_col: str, *text_cols: str, limit: int = 20_000) -> list[tuple]:
    """The rows of a reference list on the driver; more than ``limit`` raise. Rows without id or text are left out."""
    rows = reference.select(id_col, *text_cols).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"over {limit} entries in the reference list")
    return sorted(tuple(r) for r in rows if None not in tuple(r))


def party_catalog(reference: DataFrame, id_col: str = "partido_id", short_col: str = "siglas", name_col: str = "nombre") -> Catalog:
    """Parties by name, short name, or name with its words in any order."""
    rows = list_of(reference, id_col, short_col, name_col)
    none = [(i, a) for i, s, n in rows if n == "Sin Partido" for a in NO_PARTY]
    return Catalog([(i, n) for i, _, n in rows], lead=False, aliases=[(i, s) for i, s, _ in rows] + none, any_order=True)


def entry_id(value: Column, catalog: Catalog) -> Column:
    """The entry's id; -1 when the value means none; null when it is missing. Use it on distinct values."""

    @F.pandas_udf("bigint")
    def look(values: pd.Series) -> pd.Series:
        return pd.Series([catalog.best(v)[0] for v in values], dtype="Int64")

    return look(value)


def says_missing(value: Column) -> Column:
    """Whether a value is null, blank, dashes, or a word that says there is none."""

    @F.pandas_udf("boolean")
    def look(values: pd.Series) -> pd.Series:
        return values.map(is_missing).astype(bool)

    return F.when(value.isNull(), True).otherwise(look(value))
