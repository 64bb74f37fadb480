"""Visually identical text with different characters: one consistent form, and which records needed it.

The quick-check runs in the JVM as one regular expression over the value; values that pass are stable and are handed
on untouched. Only the rest goes to Python, where the unstable stretches are isolated, extended to the word around
them, normalised and spliced back (curul.functions.unicode_text).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.functions.unicode_text import UNSTABLE, canonical


def canonical_text(records: DataFrame, text_col: str, out_col: str = "canonical", changed_col: str = "needed_change") -> DataFrame:
    """All rows and columns, with the canonical text and whether the text held a character out of place.

    Null texts stay null with ``changed_col`` false; empty texts stay empty; repeated rows stay repeated. Columns of the
    names ``out_col`` and ``changed_col`` are replaced.
    """
    suspect = F.coalesce(F.col(text_col).rlike(UNSTABLE), F.lit(False))
    stable = records.where(~suspect).withColumns({out_col: F.col(text_col), changed_col: F.lit(False)})

    @F.pandas_udf("struct<t string, c boolean>")
    def fix(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield pd.DataFrame([canonical(x) for x in s], columns=["t", "c"])

    fixed = records.where(suspect).withColumn("__fixed", fix(F.col(text_col)))
    fixed = fixed.withColumns({out_col: F.col("__fixed.t"), changed_col: F.col("__fixed.c")}).drop("__fixed")
    return stable.unionByName(fixed.select(*stable.columns))
