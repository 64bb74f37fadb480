"""The pN_ queries of the operators in this package, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curul.llm.canonical_values import map_fields, read_catalog
from curul.llm.mixing import mix, shares, tempered
from curul.llm.name_variants import spelling_pairs, variant_entities
from curul.llm.near_duplicates import near_duplicate_classes, near_duplicate_pairs
from curul.llm.packing import pack, usage
from curul.llm.personal_info import find_personal, redact
from curul.llm.tokens import token_count
from curul.llm.visual_text import canonical_text
from curul.plans.state import cut
from curul.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = near_duplicate_pairs(table(spark, d, "iniciativas_pa"), "registro_id", "descripcion", 0.65)
    return pairs.select(F.col("id_a").alias("registro_id_a"), F.col("id_b").alias("registro_id_b"))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_classes(table(spark, d, "iniciativas_pa"), "registro_id", "descripcion", 0.65).withColumnRenamed("id", "registro_id")


def _catalogs(spark: SparkSession, d: str) -> dict:
    com = read_catalog(table(spark, d, "cat_comisiones"), "comision_id", "comision")
    return {"c1": com, "c2": com, "tema": read_catalog(table(spark, d, "cat_temas"), "tema_id", "tema", numbered=True)}


def p3_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Every value with its entry or the report that it has none."""
    return _mapped(spark, d, _catalogs(spark, d))


def _mapped(spark: SparkSession, d: str, catalogs: dict) -> DataFrame:
    return map_fields(table(spark, d, "iniciativas_pa"), "registro_id", catalogs).withColumnsRenamed({"id": "registro_id", "field": "campo"})


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    catalogs = _catalogs(spark, d)
    plain_number = (F.col("campo") == "tema") & F.col("value").isin([str(i) for i in catalogs["tema"].ids])
    return _mapped(spark, d, catalogs).where(~F.col("how").isin("missing", "exact") & ~plain_number).select("registro_id", "campo", "ref_id")


# Other names of having no party.
PARTY_ALIASES = {"independiente": "IND", "independente": "IND", "indep": "IND", "candidatura independiente": "IND"}


def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    """One row per spelling: the entity it names."""
    e = variant_entities(table(spark, d, "iniciativas_pa"), "registro_id", "presentador", "partido", table(spark, d, "perfiles"), "nombre", table(spark, d, "cat_partidos"), "siglas", "nombre", PARTY_ALIASES)
    return e.withColumnsRenamed({"field": "campo", "rep": "registro_id"})


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = spelling_pairs(p4_entities(spark, d).withColumnRenamed("registro_id", "rep"), "campo")
    return pairs.withColumnsRenamed({"rep_a": "registro_id_a", "rep_b": "registro_id_b"})


def p5_canonical(spark: SparkSession, d: str) -> DataFrame:
    a = canonical_text(table(spark, d, "iniciativas_pa").select(F.lit("iniciativas_pa").alias("tabla"), "registro_id", F.col("presentador").alias("texto")), "texto")
    b = canonical_text(table(spark, d, "actas_extraidas_ia").select(F.lit("actas_extraidas_ia").alias("tabla"), "registro_id", F.col("titulo").alias("texto")), "texto")
    return a.unionByName(b)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_canonical(spark, d).where("needed_change").select("tabla", "registro_id")


def _capacities(spark: SparkSession, d: str) -> dict[int, int]:
    rows = table(spark, d, "cupos").limit(101).collect()
    if len(rows) > 100:
        raise ValueError("over 100 capacities")
    return {r["cupo_id"]: r["capacidad_tokens"] for r in sorted(rows)}


def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    sized = table(spark, d, "documents").select("doc_id", token_count(F.col("text")).alias("tokens"))
    return pack(sized, "doc_id", "tokens", _capacities(spark, d)).withColumnRenamed("id", "doc_id")


def p6_usage(spark: SparkSession, d: str) -> DataFrame:
    return usage(p6_packed(spark, d), _capacities(spark, d))


# Spellings of languages in documents.
LANGUAGES = {"es": "es", "spa": "es", "español": "es", "espanol": "es", "spanish": "es", "en": "en", "eng": "en", "english": "en", "ingles": "en", "inglés": "en"}


#: Topics are aimed at by the corpus's shares raised to this power, so that rare topics gain; languages as the sources imply.
TOPIC_POWER = 0.7


def p7_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Texts used, with their number of copies: sources at their weights, topics flattened."""
    rows = table(spark, d, "mezcla_objetivo").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("over 10000 sources")
    acts = table(spark, d, "actas_extraidas_ia").where("acta_id IS NOT NULL AND tema_1 IS NOT NULL").groupBy("acta_id", "tema_1").agg(F.count("*").alias("n"))
    topic = acts.groupBy("acta_id").agg(F.min(F.struct(-F.col("n"), "tema_1"))["tema_1"].alias("topic"))
    names = F.create_map(*[x for k, v in LANGUAGES.items() for x in (F.lit(k), F.lit(v))])
    # the text itself goes no further than its digest and its length
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), "source", names[F.lower(F.trim("lang"))].alias("language"), "acta_id", token_count(F.col("text")).alias("tokens"))
    docs = docs.join(topic, "acta_id", "left")
    return mix(docs, "doc_id", "digest", "tokens", "source", {r["source"]: r["peso"] for r in rows}, {r["source"]: r["tope_repeticiones"] for r in rows}, "language", "topic", topic_targets=tempered(TOPIC_POWER)).withColumnsRenamed({"id": "doc_id", "size": "tokens"})


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return shares(cut(p7_mixed(spark, d).withColumnRenamed("tokens", "size")), table(spark, d, "mezcla_objetivo"), "source", "peso")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_personal(table(spark, d, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def p8_redacted(spark: SparkSession, d: str) -> DataFrame:
    return redact(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id", "redacted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_classes, p3_found, p3_mapped, p4_found, p4_entities, p5_found, p5_canonical, p6_packed, p6_usage, p7_mixed, p7_shares, p8_found, p8_redacted)}

_WORDS = "list_distinct(regexp_extract_all(strip_accents(lower(descripcion)), '[\\p{L}\\p{Nd}]+'))"
ORACLE: dict[str, str] = {
    "p1_found": f"""
        WITH s AS (SELECT registro_id, {_WORDS} AS w FROM iniciativas_pa WHERE descripcion IS NOT NULL),
        k AS (SELECT registro_id, w, len(w) AS n FROM s WHERE len(w) >= 8),
        t AS (SELECT registro_id, n, unnest(w) AS word FROM k),
        p AS (SELECT a.registro_id AS x, b.registro_id AS y, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
              FROM t a JOIN t b ON a.word = b.word AND a.registro_id < b.registro_id GROUP BY 1, 2)
        SELECT x AS registro_id_a, y AS registro_id_b FROM p WHERE c >= 0.65 * (na + nb - c)""",
}
