"""Mapping free-entered values to a reference list.

The list is a trie with alias paths (exchanged halves, a word left out); each distinct typed value is searched in it
with a Levenshtein automaton whose distance depends on the value's length, and all entries within it are returned
(curul.functions.lexicon). Values are made distinct before the search, so the work follows the number of spellings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.functions.lexicon import Catalog
from curul.plans.spread import spread
from curul.plans.state import cut


def read_catalog(reference: DataFrame, id_col: str, text_col: str, numbered: bool = False, limit: int = 20_000, lead: bool = True) -> Catalog:
    """The reference list as a Catalog. Lists over ``limit`` entries raise before anything is collected whole."""
    rows = reference.where(F.col(text_col).isNotNull()).select(id_col, text_col).distinct().limit(limit + 1).collect()
    return Catalog([(r[0], r[1]) for r in sorted(rows)], numbered=numbered, limit=limit, lead=lead)


#: A value in at least this share of all values is hot; there are at most the reciprocal of it, so their entries are
#: broadcast, and no other value makes a large group of the join.
HOT_SHARE = 1e-3


def search_values(values: DataFrame, catalogs: dict[str, Catalog]) -> DataFrame:
    """(kind, value, n, ref_id, how, candidates) of each distinct non-null (kind, value); kind names the catalog.

    ``how`` is exact, number, entry, alias, cut (the value stops early), none or missing; ref_id is -1 for none and
    null for missing. ``candidates`` holds every entry within the allowed distance as (cost, ref_id), nearest first: one
    search gives them and the entry meant. ``n`` is how often the value occurs.
    """
    shared = values.sparkSession.sparkContext.broadcast(catalogs)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for b in batches:
            rows = []
            for kind, v, n in zip(b["kind"], b["value"], b["n"]):
                near = c[kind].near(v)
                rows.append((kind, v, n, *c[kind].decide(v, near), [(float(x), int(i)) for x, i, _ in near]))
            out = pd.DataFrame(rows, columns=["kind", "value", "n", "ref_id", "how", "candidates"])
            out["ref_id"] = out["ref_id"].astype("Int64")
            yield out

    distinct = values.where("value IS NOT NULL").groupBy("kind", "value").agg(F.count("*").alias("n"))
    return spread(distinct, "value").mapInPandas(search, "kind string, value string, n bigint, ref_id bigint, how string, candidates array<struct<cost: double, ref_id: bigint>>")


def match_values(values: DataFrame, value_col: str, catalog: Catalog) -> DataFrame:
    """(value, ref_id, how, candidates) of the distinct non-null values of one column."""
    return search_values(values.select(F.lit("").alias("kind"), F.col(value_col).alias("value")), {"": catalog}).select("value", "ref_id", "how", "candidates")


def map_fields(records: DataFrame, id_col: str, fields: dict[str, Catalog]) -> DataFrame:
    """(id, field, value, ref_id, how, candidates), one row per record and field; null values give how = missing and no
    candidates.

    All fields share one pass over the records; fields of one catalog share its searches, one per distinct value.
    """
    kinds = {f: next(g for g, other in fields.items() if other is c) for f, c in fields.items()}
    entries = [F.struct(F.lit(f).alias("field"), F.lit(kinds[f]).alias("kind"), F.col(f).cast("string").alias("value")) for f in fields]
    long = records.select(F.col(id_col).alias("id"), F.explode(F.array(*entries)).alias("e")).select("id", "e.field", "e.kind", "e.value")
    found = cut(search_values(long, {k: fields[k] for k in kinds.values()}))
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.col("n") >= max(1.0, HOT_SHARE * total)
    answer = ["ref_id", "how", "candidates"]
    often = long.join(F.broadcast(found.where(hot).withColumn("often", F.lit(True)).drop("n")), ["kind", "value"], "left")
    first = often.where("often").select("id", "field", "value", *answer)
    rest = often.where("often IS NULL").drop("often", *answer).join(found.where(~hot).drop("n"), ["kind", "value"], "left")
    rest = rest.select("id", "field", "value", "ref_id", F.coalesce("how", F.lit("missing")).alias("how"), F.coalesce("candidates", F.array().cast("array<struct<cost: double, ref_id: bigint>>")).alias("candidates"))
    return first.unionByName(rest)
