"""Parties and topics of initiative records: typed values brought to ids, gaps filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.functions.catalog_udf import entry_id, list_of, party_catalog, says_missing
from curul.functions.lexicon import Catalog
from curul.operators.imputation import fill_missing, find_dependencies
from curul.operators.name_resolution import person_of_spelling
from curul.plans.spread import spread
from curul.plans.state import cut


#: Share of the complete records that must bear a dependency out before it fills anything.
LEAST_CONFIDENCE = 0.99


def _ids(records: DataFrame, col: str, catalog: Catalog) -> DataFrame:
    """(col, col_id, col_missing) of every distinct non-null value."""
    v = records.select(col).where(F.col(col).isNotNull()).distinct()
    return cut(spread(v, col).withColumns({f"{col}_id": entry_id(F.col(col), catalog), f"{col}_missing": says_missing(F.col(col))}))


def identified(records: DataFrame, roster: DataFrame, committees: DataFrame, topics: DataFrame, parties: DataFrame) -> DataFrame:
    """(registro_id, legislatura, person, partido_id, partido_missing, comision_id, tema_id, tema_missing).

    person is null unless the presenter is a single person. Ids are null where the value is missing or names no entry.
    """
    rec = records.select("registro_id", "legislatura", "presentador", "partido", "tema", "c1")
    com = Catalog(list_of(committees, "comision_id", "comision"))
    top = Catalog(list_of(topics, "tema_id", "tema"), numbered=True)
    who = cut(person_of_spelling(rec, "presentador", roster, "nombre").where("kind = 'person'").select(F.col("spelling").alias("presentador"), "person"))
    out = rec.join(who, "presentador", "left")
    for col, catalog in (("partido", party_catalog(parties)), ("tema", top), ("c1", com)):
        out = out.join(_ids(rec, col, catalog), col, "left")
    known = lambda c: F.when(F.col(c) >= 1, F.col(c))
    return out.select(
        "registro_id", "legislatura", "person",
        known("partido_id").alias("partido_id"), F.coalesce("partido_missing", F.lit(True)).alias("partido_missing"),
        known("c1_id").alias("comision_id"), known("tema_id").alias("tema_id"), F.coalesce("tema_missing", F.lit(True)).alias("tema_missing"),
    )


def filled(ids: DataFrame) -> DataFrame:
    """The rows of ``identified`` with partido_id and tema_id filled in: by the dependencies mined from the complete
    records, then by the usual value of the same person in the same legislature, or of the same committee.

    Only fields that are missing are filled; a value that names no entry stays as it is. The sources say how.
    """
    ids = cut(ids)
    columns = ["person", "legislatura", "comision_id", "tema_id", "partido_id"]
    out = ids
    for target, group in (("partido_id", ["person", "legislatura"]), ("tema_id", ["comision_id"])):
        mined = find_dependencies(ids, [c for c in columns if c != target], target, least_confidence=LEAST_CONFIDENCE)
        out = fill_missing(out if out is ids else cut(out), target, mined, group=None if group in mined else group)
        field = target.removesuffix("_id")
        allowed = (F.col(f"{target}_source") == "observed") | F.col(f"{field}_missing")
        out = out.withColumn(f"{field}_source", F.when(allowed, F.col(f"{target}_source")))
    return out


def filled_values(done: DataFrame) -> DataFrame:
    """(registro_id, campo, valor_id) of the missing fields that the same person in the same legislature, or the
    committee, fills; what other dependencies fill is no case."""
    a = done.where("partido_source IN ('dependency:person+legislatura', 'group:person+legislatura')").select("registro_id", F.lit("partido").alias("campo"), F.col("partido_id_filled").alias("valor_id"))
    b = done.where("tema_source IN ('dependency:comision_id', 'group:comision_id')").select("registro_id", F.lit("tema").alias("campo"), F.col("tema_id_filled").alias("valor_id"))
    return a.unionByName(b)
