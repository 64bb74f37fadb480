"""State kept between runs: what is pending, and merging results without losing better ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending(sources: DataFrame, state: DataFrame, key: str, version: int = 1, again: bool = False, force: bool = False) -> DataFrame:
    """Sources to work on: those the state lacks or has not finished; with ``again`` also those of an older version.

    state: (key, finished boolean, version int), one row a key. Null keys are always pending."""
    if force:
        return sources
    done = state.where("finished" + (f" AND version >= {int(version)}" if again else "")).select(key)
    return sources.join(done, key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and old rows whose key isn't among them."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def upsert_by_status(old: DataFrame, new: DataFrame, key: str, status: str, order: list[str]) -> DataFrame:
    """One row a key: a finished entry ("ok") is never replaced by a failed one; of equals the later by order wins."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c != key]
    rank = F.when(F.col(status) == "ok", 1).otherwise(0)
    b = both.groupBy(key).agg(F.max(F.struct(rank.alias("__ok"), F.col("__new").alias("__fresh"), *order, *[c for c in rest if c not in order])).alias("b"))
    return b.select(key, *[F.col(f"b.{c}").alias(c) for c in rest if c != "__new"])


def status_summary(state: DataFrame, finished: str, error: str) -> DataFrame:
    """(total, finished, with_error, pending) in one row."""
    return state.agg(F.count("*").alias("total"), F.count_if(F.col(finished)).alias("finished"), F.count_if(F.col(error).isNotNull()).alias("with_error"), F.count_if(~F.coalesce(F.col(finished), F.lit(False))).alias("pending"))


def migrate_by_date(records: DataFrame, documents: DataFrame, date_col: str, doc_col: str) -> DataFrame:
    """Records with the first document of their date; those of dates without one go to the orphan document (null)."""
    first = documents.groupBy(date_col).agg(F.min(doc_col).alias(doc_col))
    return records.join(first, date_col, "left")


def pending_after(rows: DataFrame, seq: str, stop: int, predicate: Column) -> DataFrame:
    """(rows_after, pending_after): how many rows follow the one at which work stopped, and how many still need it."""
    after = F.col(seq) > stop
    return rows.agg(F.count_if(after).alias("rows_after"), F.count_if(after & F.coalesce(predicate, F.lit(False))).alias("pending_after"))
