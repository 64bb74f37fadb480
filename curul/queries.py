"""Queries over the core's operators, each with its SQL where SQL can express it. Every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curul.functions import calendar as cal
from curul.functions import classify, cleaning, records
from curul.functions.similarity import canonical_form, containment, dice, jaccard
from curul.functions.text import fold, words
from curul.operators import aggregates as agg
from curul.operators import documents as docs
from curul.operators import incremental as inc
from curul.operators import joins, numbering, quality
from curul.operators.imputation import mine_dependencies
from curul.operators.initiatives import filled, filled_values, identified
from curul.operators.linkage import candidate_links, link_in_order, review_list
from curul.plans.state import cut, shared_folder
from curul.sources.envelopes import union_all
from curul.sources.tables import table
from curul.streaming.tables import read_growing, run_to_table, window_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its name, with its SQL if it has one."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _identified(spark: SparkSession, d: str) -> DataFrame:
    return identified(*[table(spark, d, t) for t in ("iniciativas_pa", "perfiles", "cat_comisiones", "cat_temas", "cat_partidos")])


@query()
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return filled_values(filled(_identified(spark, d)))


@query()
def p2_filled(spark: SparkSession, d: str) -> DataFrame:
    """Every record with its values, filled ones marked by their source."""
    return filled(_identified(spark, d)).select("registro_id", "legislatura", "person", "comision_id", "partido_id", "partido_id_filled", "partido_source", "tema_id", "tema_id_filled", "tema_source")


DETERMINANTS = [["presentador", "legislatura"], ["presentador"], ["c1"], ["c1", "c2"]]


def _dependency_sql(d: list[str], target: str) -> str:
    k = ", ".join(d)
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*d, target])
    return f"""SELECT '{'+'.join(d)}' AS determinant, '{target}' AS target, coalesce(sum(total), 0)::BIGINT AS records, count(*) AS groups,
        coalesce(sum(n), 0)::BIGINT AS agreeing, sum(n) / sum(total) AS confidence, coalesce(sum(n) / sum(total) >= 0.5, false) AS verified
        FROM (SELECT {k}, sum(n) AS total, max(n) AS n FROM (SELECT {k}, {target}, count(*) AS n FROM iniciativas_pa WHERE {known} GROUP BY {k}, {target}) GROUP BY {k}) WHERE total >= 2"""


@query(" UNION ALL ".join(_dependency_sql(d, t) for t in ("partido", "tema") for d in DETERMINANTS))
def p2_dependencies(spark: SparkSession, d: str) -> DataFrame:
    """Which columns determine party and topic, over the values as typed."""
    r = table(spark, d, "iniciativas_pa")
    return mine_dependencies(r, DETERMINANTS, "partido", 0.5).unionByName(mine_dependencies(r, DETERMINANTS, "tema", 0.5))

# --- calendar and numbering -------------------------------------------------------------------------------------

_MD = "(month(d) * 100 + day(d))"
_CY = f"(year(d) - CASE WHEN {_MD} >= 915 THEN 0 ELSE 1 END)"
_TERM = f"({_CY} - (({_CY} - 2024) % 3 + 3) % 3)"
_YEAR = f"((({_CY} - 2024) % 3 + 3) % 3 + 1)"
_PERIOD = f"CASE WHEN {_MD} >= 915 OR {_MD} <= 114 THEN 1 WHEN {_MD} <= 514 THEN 2 ELSE 3 END"


@query(f"""
    WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS d FROM orders),
    c AS (SELECT *, {_TERM} AS term, {_YEAR} AS legislative_year, {_PERIOD} AS period FROM o),
    f AS (SELECT *, CASE WHEN lag(term) OVER w IS NOT DISTINCT FROM term AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS ft,
        CASE WHEN lag(term) OVER w IS NOT DISTINCT FROM term AND lag(legislative_year) OVER w IS NOT DISTINCT FROM legislative_year
             AND lag(period) OVER w IS NOT DISTINCT FROM period AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS fp
        FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
    r AS (SELECT *, sum(ft) OVER w AS rt, sum(fp) OVER w AS rp FROM f WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
    SELECT o_custkey, o_orderkey, term::INT AS term, legislative_year::INT AS legislative_year, period::INT AS period,
        row_number() OVER (PARTITION BY o_custkey, rt ORDER BY o_orderkey)::INT AS folio_term,
        row_number() OVER (PARTITION BY o_custkey, rp ORDER BY o_orderkey)::INT AS folio_period FROM r""")
def folio_runs(spark: SparkSession, d: str) -> DataFrame:
    """Both running folios of each customer's orders in the order of their keys, whatever their dates."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return numbering.folios(o, ["o_custkey"], ["o_orderkey"], "day").drop("day")


@query(f"""
    WITH c AS (SELECT o_orderkey, d, {_TERM} AS term, {_YEAR} AS y, {_PERIOD} AS p FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))
    SELECT o_orderkey, row_number() OVER (PARTITION BY term ORDER BY d, o_orderkey)::INT AS folio_term,
        row_number() OVER (PARTITION BY term, y, p ORDER BY d, o_orderkey)::INT AS folio_period FROM c""")
def folio_chronological(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return numbering.folios_by_key(o, ["day", "o_orderkey"], "day").select("o_orderkey", "folio_term", "folio_period")


@query(f"""
    WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
    SELECT o_orderkey, {_YEAR}::INT AS legislative_year, {_PERIOD} AS period,
        CASE WHEN {_MD} BETWEEN 915 AND 1215 OR {_MD} BETWEEN 115 AND 315 OR {_MD} BETWEEN 515 AND 715 THEN 'periodo' ELSE 'receso' END AS kind FROM o""")
def period_year_recess(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", cal.legislative_year("d").alias("legislative_year"), cal.period("d").alias("period"), cal.period_or_recess("d")["kind"].alias("kind"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d') || '|' || event_type || '|' || row_number() OVER (PARTITION BY ts::DATE, event_type ORDER BY ts, event_id) AS session_key FROM events""")
def session_key(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return numbering.ordinal(e, ["day", "event_type"], ["ts", "event_id"], "n").select("event_id", F.concat_ws("|", F.date_format("day", "yyyy-MM-dd"), "event_type", "n").alias("session_key"))


@query("""
    WITH f AS (SELECT event_id, user_id, ts, event_type, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS f
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM f)
    SELECT event_id, run::BIGINT AS run, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS number FROM r""")
def run_counter(spark: SparkSession, d: str) -> DataFrame:
    """Islands of equal event types of each user and the number within."""
    return numbering.run_numbers(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("event_id", "run", "number")


@query("""SELECT o_orderkey, coalesce(o_orderdate < last_value(o_orderdate IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS out_of_order FROM orders""")
def out_of_order(spark: SparkSession, d: str) -> DataFrame:
    return numbering.out_of_order(table(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], "o_orderdate").select("o_orderkey", "out_of_order")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_purchase FROM events""")
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("value")))
    return numbering.forward_fill(e, ["user_id"], ["ts", "event_id"], "p", "last_purchase").select("event_id", "last_purchase")


@query("""
    WITH r AS (SELECT sesion_id, numero_de_sesion, row_number() OVER (PARTITION BY fecha, tipo_de_sesion ORDER BY sesion_id) AS rn, min(sesion_id) OVER (PARTITION BY fecha, tipo_de_sesion) AS first FROM (SELECT DISTINCT sesion_id, numero_de_sesion, fecha, tipo_de_sesion FROM sesiones))
    SELECT sesion_id, CASE WHEN first <> sesion_id THEN first END AS first_row FROM r""")
def repeated_sessions(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sesiones").select("sesion_id", "numero_de_sesion", "fecha", "tipo_de_sesion").distinct()
    return numbering.first_seen_row(s, ["fecha", "tipo_de_sesion"], ["sesion_id"], "sesion_id").select("sesion_id", "first_row")


# --- dates and times --------------------------------------------------------------------------------------------


@query("""
    SELECT registro_id, strftime(try_strptime(fecha_pres, '%d/%m/%y'), '%Y-%m-%d') AS presented, strftime(try_strptime(fecha_aprobacion, '%d/%m/%y'), '%Y-%m-%d') AS approved,
        date_diff('day', try_strptime(fecha_pres, '%d/%m/%y'), try_strptime(fecha_aprobacion, '%d/%m/%y'))::INT AS days FROM iniciativas_pa""")
def date_difference(spark: SparkSession, d: str) -> DataFrame:
    p, a = cal.any_date("fecha_pres"), cal.any_date("fecha_aprobacion")
    return table(spark, d, "iniciativas_pa").select("registro_id", p.cast("string").alias("presented"), a.cast("string").alias("approved"), F.datediff(a, p).alias("days"))


@query("""
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def date_forms(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written in four forms by turns and read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    k = F.pmod("o_orderkey", F.lit(4))
    text = F.when(k == 0, F.date_format("d", "yyyy-MM-dd")).when(k == 1, F.date_format("d", "d/M/yyyy")).when(k == 2, cal.prose_date("d")).otherwise(F.datediff("d", F.lit("1899-12-30").cast("date")).cast("string"))
    return o.select("o_orderkey", cal.any_date(text).cast("string").alias("day"))


_SEC = "(CASE WHEN upper(h) LIKE '%P%M%' THEN (split_part(h, ':', 1)::INT % 12) + 12 ELSE split_part(h, ':', 1)::INT % 12 END * 3600 + split_part(h, ':', 2)::INT * 60 + substr(split_part(h, ':', 3), 1, 2)::INT)"
_S24 = "(split_part({0}, ':', 1)::INT * 3600 + split_part({0}, ':', 2)::INT * 60 + split_part({0}, ':', 3)::INT)"


@query(f"""
    WITH t AS (SELECT sesion_id, {_SEC} AS called, {_S24.format('inicio_de_sesion')} AS begun, {_S24.format('fin_de_sesion')} AS ended FROM (SELECT *, hora_de_cita AS h FROM sesiones))
    SELECT sesion_id, called, begun, begun - called AS delay_s, floor((begun - called) / 60.0)::BIGINT AS delay_min, ((ended - begun) % 86400 + 86400) % 86400 AS duration_s FROM t""")
def time_delay_duration(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "sesiones").select("sesion_id", cal.seconds_of_day("hora_de_cita").alias("called"), cal.seconds_of_day("inicio_de_sesion").alias("begun"), cal.seconds_of_day("fin_de_sesion").alias("ended"))
    return s.select("sesion_id", "called", "begun", cal.delay_seconds("called", "begun").alias("delay_s"), cal.delay_minutes("called", "begun").alias("delay_min"), cal.duration_seconds("begun", "ended").alias("duration_s"))


# --- aggregates -------------------------------------------------------------------------------------------------

_TYPES = ["signup", "purchase", "error", "view", "click"]


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in _TYPES) + " FROM events GROUP BY 1")
def category_totals(spark: SparkSession, d: str) -> DataFrame:
    return agg.category_counts(table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd")), ["day"], "event_type", _TYPES)


_VOTES = "(SELECT votacion_id, unnest(votaciones, max_depth := 2) FROM votaciones)"
_KIND = "CASE WHEN lower(strip_accents(voto)) LIKE '%favor%' THEN 'favor' WHEN lower(strip_accents(voto)) LIKE '%contra%' THEN 'contra' WHEN lower(strip_accents(voto)) LIKE '%abstencion%' THEN 'abstencion' ELSE 'no_reconocido' END"


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "votaciones").select("votacion_id", "fecha", "numero_votacion", F.explode("votaciones").alias("v")).select("votacion_id", "fecha", "numero_votacion", "v.*")


@query(f"""
    WITH v AS (SELECT votacion_id, {_KIND} AS kind FROM {_VOTES})
    SELECT votacion_id, count(*) FILTER (kind = 'favor') AS n_favor, count(*) FILTER (kind = 'contra') AS n_contra, count(*) FILTER (kind = 'abstencion') AS n_abstencion, count(*) FILTER (kind = 'no_reconocido') AS n_no_reconocido FROM v GROUP BY 1""")
def vote_tally(spark: SparkSession, d: str) -> DataFrame:
    return agg.category_counts(_votes(spark, d).withColumn("kind", classify.vote_kind("voto")), ["votacion_id"], "kind", ["favor", "contra", "abstencion", "no_reconocido"])


@query("""
    SELECT registro_id, a_favor + contra + abstenciones + ausentes AS total, (a_favor + contra + abstenciones) / nullif(a_favor + contra + abstenciones + ausentes, 0) AS participation,
        CASE WHEN a_favor + contra + abstenciones IS NOT NULL THEN greatest(a_favor, contra, abstenciones) / nullif(a_favor + contra + abstenciones, 0) END AS unity
    FROM (SELECT registro_id, CASE WHEN registro_id % 9 <> 0 THEN a_favor ELSE 0 END AS a_favor, CASE WHEN registro_id % 9 <> 0 THEN contra ELSE 0 END AS contra, CASE registro_id % 9 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE abstenciones END AS abstenciones, CASE WHEN registro_id % 18 <> 0 THEN ausentes ELSE 0 END AS ausentes FROM actas_extraidas_ia)""")
def participation_unity(spark: SparkSession, d: str) -> DataFrame:
    """Ratios of all votes; a ninth of them without votes and some without a number, so that ratios over nothing occur."""
    k = F.pmod("registro_id", F.lit(9))
    none = lambda c: F.when(k != 0, F.col(c)).otherwise(0)
    a = table(spark, d, "actas_extraidas_ia").select("registro_id", none("a_favor").alias("f"), none("contra").alias("c"), F.when(k != 1, none("abstenciones")).alias("a"), F.when(F.pmod("registro_id", F.lit(18)) != 0, F.col("ausentes")).otherwise(0).alias("x"))
    return a.select("registro_id", *[c.alias(n) for n, c in agg.participation(*[F.col(c) for c in "fcax"]).items()])


_CODES = ["A favor", "En contra", "Abstención", "Ausente", "Secreto"]


@query("SELECT diputado, " + ", ".join(f"count(*) FILTER (voto = '{c}') AS \"{c}\"" for c in _CODES) + f" FROM {_VOTES} GROUP BY 1")
def member_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _votes(spark, d).groupBy("diputado").pivot("voto", _CODES).count().na.fill(0)


@query("SELECT user_id, " + ", ".join(f"CASE WHEN count(*) FILTER (event_type = '{t}') = 0 THEN '-' ELSE max(CASE WHEN event_type = '{t}' THEN strftime(ts, '%Y-%m-%d') END) END AS {t}" for t in _TYPES) + " FROM events GROUP BY 1")
def pivot_default(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return agg.pivot_values(e, ["user_id"], "event_type", "day", _TYPES)


@query(f"""
    WITH v AS (SELECT diputado, partido, votacion_id FROM {_VOTES}), r AS (SELECT *, row_number() OVER (PARTITION BY diputado ORDER BY votacion_id, partido) AS rn FROM v)
    SELECT diputado, votacion_id, partido FROM r WHERE rn = 1""")
def first_seen(spark: SparkSession, d: str) -> DataFrame:
    return agg.first_by(_votes(spark, d).where("diputado IS NOT NULL AND partido IS NOT NULL"), ["diputado"], ["votacion_id", "partido"], ["votacion_id", "partido"])


@query("""
    WITH k AS (SELECT trim(regexp_replace(lower(strip_accents(c1)), '[^a-z0-9]+', ' ', 'g')) AS key, c1, count(*) AS n FROM iniciativas_pa WHERE c1 IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, c1) AS rn FROM k)
    SELECT key, c1 AS label, n FROM r WHERE rn = 1""")
def canonical_label(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "iniciativas_pa").where("c1 IS NOT NULL").withColumn("key", cleaning.alnum_words("c1"))
    return agg.most_frequent(r, ["key"], "c1", "label")


@query("""
    WITH m AS (SELECT n_regionkey AS committee, s_suppkey AS seq, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'Presidencia' WHEN s_suppkey % 5 = 1 THEN 'Secretaría' ELSE 'Vocal' END AS role, CASE WHEN s_acctbal > 0 THEN 'Mujer' ELSE 'Hombre' END AS gender
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT committee, count(*) AS members, count(*) FILTER (gender = 'Mujer') AS women, count(*) FILTER (gender <> 'Mujer') AS men, arg_max(name, seq) FILTER (role = 'Presidencia') AS president,
        coalesce((arg_max(gender, seq) FILTER (role = 'Presidencia')) = 'Mujer', false)::INT AS president_is_woman, arg_max(name, seq) FILTER (role = 'Secretaría') AS secretary, count(*) FILTER (role = 'Secretaría') AS secretaries,
        string_agg(name, ';' ORDER BY seq) FILTER (role = 'Vocal') AS others FROM m GROUP BY 1""")
def committee_profile(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.pmod("s_suppkey", F.lit(5))
    m = m.select(F.col("n_regionkey").alias("committee"), F.col("s_suppkey").alias("seq"), F.col("s_name").alias("name"), classify.role(F.when(k == 0, "Presidenta").when(k == 1, "Secretario").otherwise("Vocal")).alias("role"), F.when(F.col("s_acctbal") > 0, "Mujer").otherwise("Hombre").alias("gender"))
    return agg.committee_profile(m, "committee", "name", "role", "gender", "seq").withColumn("others", F.array_join("others", ";"))


@query("""
    SELECT legislatura, anio, count(*) AS records, count(DISTINCT c1) AS committees, grouping(anio)::INT AS level FROM iniciativas_pa GROUP BY ROLLUP (legislatura, anio)""")
def session_rollup(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "iniciativas_pa").rollup("legislatura", "anio").agg(F.count("*").alias("records"), F.count_distinct("c1").alias("committees"), F.grouping("anio").cast("int").alias("level"))
    return r


@query("""
    WITH p AS (SELECT estatus, tipo, count(*) AS n FROM iniciativas_pa GROUP BY 1, 2)
    SELECT estatus, tipo, n FROM p""")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").groupBy("estatus", "tipo").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("""
    WITH p AS (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lang) AS rn FROM p)
    SELECT source, sum(n)::BIGINT AS n, string_agg(lang, ',' ORDER BY lang) FILTER (rn <= 8) AS examples FROM r GROUP BY 1""")
def grouped_examples(spark: SparkSession, d: str) -> DataFrame:
    return agg.examples(table(spark, d, "documents").where("lang IS NOT NULL"), ["source"], "lang").withColumn("examples", F.array_join("examples", ","))


@query("""
    WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{Nd}]+')) AS word FROM documents), n AS (SELECT count(*) AS docs FROM documents)
    SELECT word, count(*) AS df, round(ln((any_value(docs) + 1) / (count(*) + 0.5)), 9) AS idf FROM w, n GROUP BY 1""")
def document_frequency(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "documents").select("doc_id", words("text").alias("words"))
    return agg.document_frequency(w, "doc_id", "words").withColumn("idf", F.round("idf", 9))


@query("""
    SELECT * EXCLUDE (rn) FROM (SELECT nombre, ultimo_grado_de_estudios AS grado, folio_foto, row_number() OVER (PARTITION BY partido ORDER BY CASE ultimo_grado_de_estudios WHEN 'Licenciatura' THEN 1 WHEN 'Maestría' THEN 2 WHEN 'Doctorado' THEN 3 ELSE 4 END, folio_foto, nombre) AS rn, partido FROM perfiles WHERE partido IS NOT NULL) WHERE rn = 1""")
def degree_preference(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "perfiles").where("partido IS NOT NULL").withColumnRenamed("ultimo_grado_de_estudios", "grado")
    return agg.best_by_preference(p, ["partido"], "grado", ["Licenciatura", "Maestría", "Doctorado"], ["folio_foto", "nombre"], ["nombre", "grado", "folio_foto"])


@query("SELECT DISTINCT ON (folio_foto) folio_foto, nombre, partido FROM perfiles WHERE folio_foto IS NOT NULL ORDER BY folio_foto, nombre")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return agg.keep_first(table(spark, d, "perfiles").select("folio_foto", "nombre", "partido").where("folio_foto IS NOT NULL"), ["folio_foto"], ["nombre"])


# --- scans, nulls, types ----------------------------------------------------------------------------------------

_NULLS = ", ".join("'" + w + "'" for w in cleaning.NULL_WORDS)


@query("""
    SELECT 'region' AS origin, r_regionkey::BIGINT AS id, r_name AS name, NULL::DOUBLE AS balance FROM region UNION ALL SELECT 'nation', n_nationkey, n_name, NULL FROM nation UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal FROM supplier""")
def schema_union(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "region").select(F.lit("region").alias("origin"), F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"))
    n = table(spark, d, "nation").select(F.lit("nation").alias("origin"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return union_all([r, n, s])


@query(f"""SELECT registro_id, CASE WHEN lower(trim(partido)) NOT IN ({_NULLS}) THEN partido END AS partido, CASE WHEN lower(trim(tema)) NOT IN ({_NULLS}) THEN tema END AS tema FROM iniciativas_pa""")
def null_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").select("registro_id", *[cleaning.null_words(c).alias(c) for c in ("partido", "tema")])


@query(f"""
    WITH v AS (SELECT registro_id, tema, CASE WHEN lower(trim(tema)) NOT IN ({_NULLS}) THEN tema END AS k FROM iniciativas_pa)
    SELECT registro_id, try_cast(trim(k) AS DOUBLE) AS value, CASE WHEN k IS NULL THEN 'empty' WHEN try_cast(trim(k) AS DOUBLE) IS NOT NULL THEN 'ok' ELSE 'invalid' END AS status, tema AS raw FROM v""")
def typed_convert(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "iniciativas_pa").select("registro_id", cleaning.convert("tema", "number").alias("c"))
    return r.select("registro_id", F.col("c.value").cast("double").alias("value"), "c.status", "c.raw")


@query("""SELECT event_id, (props::JSON->>'k')::INT AS k FROM events""")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("""SELECT 'iniciativas' AS t, count(*) AS n, count(partido) AS known FROM iniciativas_pa UNION ALL SELECT 'actas', count(*), count(titulo) FROM actas_extraidas_ia""")
def source_counts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "iniciativas_pa").agg(F.lit("iniciativas").alias("t"), F.count("*").alias("n"), F.count("partido").alias("known"))
    return a.unionByName(table(spark, d, "actas_extraidas_ia").agg(F.lit("actas").alias("t"), F.count("*").alias("n"), F.count("titulo").alias("known")))


# --- text -------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\n?Pag\\. *\\d+\\n?', ' ', 'gi'), '\\s+', ' ', 'g')) AS clean FROM documents""")
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", cleaning.flat_text("text").alias("clean"))


@query("""SELECT registro_id, trim(regexp_replace(lower(strip_accents(descripcion)), '[^a-z0-9]+', ' ', 'g')) AS norm, substr(md5(trim(regexp_replace(lower(strip_accents(descripcion)), '[^a-z0-9]+', ' ', 'g'))), 1, 16) AS key FROM iniciativas_pa""")
def norm_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").select("registro_id", cleaning.alnum_words("descripcion").alias("norm"), cleaning.short_key("descripcion").alias("key"))


@query(f"""
    SELECT registro_id, CASE WHEN descripcion IS NULL THEN NULL WHEN regexp_matches(lower(strip_accents(descripcion)), '{"|".join(classify.INITIATIVE_WORDS)}') THEN 1
        WHEN regexp_matches(lower(strip_accents(descripcion)), '{"|".join(classify.AGREEMENT_WORDS)}') THEN 2 ELSE 0 END AS class FROM iniciativas_pa""")
def keyword_class(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").select("registro_id", classify.keyword_class("descripcion").alias("class"))


@query("""
    SELECT sesion_id, CASE WHEN t LIKE '%comision permanente%' THEN 'Comisión Permanente' WHEN t LIKE '%solemne%' THEN 'Solemne' WHEN t LIKE '%extraordinaria%' THEN 'Extraordinaria' WHEN t LIKE '%previa%' THEN 'Previa' WHEN t LIKE '%ordinaria%' THEN 'Ordinaria' ELSE trim(tipo_de_sesion) END AS kind
    FROM (SELECT sesion_id, tipo_de_sesion, lower(strip_accents(tipo_de_sesion)) AS t FROM sesiones)""")
def session_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sesiones").select("sesion_id", classify.session_kind("tipo_de_sesion").alias("kind"))


@query("""
    WITH p AS (SELECT doc_id, string_split_regex(text, '\\n?Pag\\. *\\d+\\n') AS parts, regexp_extract_all(text, '\\n?Pag\\. *(\\d+)\\n', 1) AS nums FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, unnest(range(len(parts))) AS i, parts, nums FROM p)
    SELECT doc_id, i::INT AS position, CASE WHEN i < len(nums) THEN nums[i + 1]::INT ELSE -1 END AS page, length(parts[i + 1])::INT AS chars FROM e""")
def page_split(spark: SparkSession, d: str) -> DataFrame:
    return docs.pages(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "position", "page", F.length("text").alias("chars"))


@query("""
    SELECT doc_id, list_max(list_transform(regexp_extract_all(text, '(\\d{1,3})\\. (?:Lectura|Asuntos)', 1), lambda x: x::INT)) AS highest, len(regexp_extract_all(text, 'En votación')) AS votes FROM documents""")
def agenda_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The highest agenda number and the number of a phrase in each document."""
    n = F.array_max(F.transform(F.regexp_extract_all("text", F.lit(r"(\d{1,3})\. (?:Lectura|Asuntos)"), F.lit(1)), lambda x: x.cast("int")))
    return table(spark, d, "documents").select("doc_id", n.alias("highest"), F.regexp_count("text", F.lit("En votación")).alias("votes"))


@query("""
    SELECT doc_id, try_cast(nullif(regexp_extract(text, '(\\d{1,4}) votos? a favor', 1), '') AS INT) AS f, try_cast(nullif(regexp_extract(lower(strip_accents(text)), '(\\d{1,4}) en contra', 1), '') AS INT) AS c FROM documents""")
def vote_counts(spark: SparkSession, d: str) -> DataFrame:
    v = docs.vote_counts(F.col("text"))
    return table(spark, d, "documents").select("doc_id", v["f"].alias("f"), v["c"].alias("c"))


@query("""
    WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '(\\d{1,2}:\\d{2}) horas del (\\d{1,2}/\\d{1,2}/\\d{4})', 1)) AS t, unnest(regexp_extract_all(text, '(\\d{1,2}:\\d{2}) horas del (\\d{1,2}/\\d{1,2}/\\d{4})', 2)) AS day, generate_subscripts(regexp_extract_all(text, '(\\d{1,2}:\\d{2}) horas del (\\d{1,2}/\\d{1,2}/\\d{4})', 1), 1) AS k FROM documents)
    SELECT doc_id, day, arg_max(t, k) AS time FROM m GROUP BY 1, 2""")
def notice_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(docs.last_time_by_day(F.col("text"))).alias("day", "time"))


@query("""SELECT registro_id, nullif(regexp_extract(descripcion, '(?i)art[ií]culos? (\\d+)', 1), '') AS article, nullif(regexp_extract(descripcion, '((?:Ley|Código|Reglamento|Estatuto)(?: [A-Z][a-záéíóúñ]+)?) de', 1), '') AS law FROM iniciativas_pa""")
def law_references(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").select("registro_id", F.nullif(F.regexp_extract("descripcion", r"(?iu)art[ií]culos? (\d+)", 1), F.lit("")).alias("article"), F.nullif(F.regexp_extract("descripcion", r"((?:Ley|Código|Reglamento|Estatuto)(?: [A-Z][a-záéíóúñ]+)?) de", 1), F.lit("")).alias("law"))


@query("""
    SELECT folio_foto, nombre, CASE WHEN c IS NULL THEN NULL WHEN regexp_matches(c, '^[a-z0-9._+-]+@[a-z0-9-]+(\\.[a-z0-9-]+)+$') THEN 'email' WHEN c LIKE '%facebook%' THEN 'facebook' WHEN regexp_matches(c, 'twitter|x\\.com|^@') THEN 'twitter' WHEN regexp_matches(c, '^[+()0-9 .-]{7,}$') THEN 'telefono' ELSE 'otro' END AS kind
    FROM (SELECT folio_foto, nombre, trim(lower(unnest([telefono_de_oficina, correo, facebook, twitter]))) AS c FROM perfiles)""")
def contact_kinds(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "perfiles").select("folio_foto", "nombre", F.explode(F.array("telefono_de_oficina", "correo", "facebook", "twitter")).alias("c"))
    return p.select("folio_foto", "nombre", classify.contact_kind("c").alias("kind"))


@query("""
    SELECT nombre, folio_foto, replace(translate(w[-2] || ' ' || w[-1] || '|' || array_to_string(w[:-3], ' '), 'áéíóúü', 'aeiouu'), 'ñ', 'n￿') AS key FROM (SELECT DISTINCT nombre, folio_foto, string_split(lower(nombre), ' ') AS w FROM perfiles WHERE nombre IS NOT NULL)""")
def surname_order(spark: SparkSession, d: str) -> DataFrame:
    """Roster names by surnames, then given names, ñ after n."""
    p = table(spark, d, "perfiles").where("nombre IS NOT NULL").select("nombre", "folio_foto").distinct()
    return p.withColumn("key", records.surname_key("nombre")).orderBy("key")


@query("""
    WITH s AS (SELECT registro_id, list_filter([c1, c2, c3, c4, c5, c6], lambda x: x IS NOT NULL AND trim(x) <> '') AS c FROM iniciativas_pa)
    SELECT registro_id, unnest(c) AS committee, generate_subscripts(c, 1)::INT AS slot FROM s""")
def slots(spark: SparkSession, d: str) -> DataFrame:
    """Committee slots as rows in their order."""
    c = F.filter(F.array("c1", "c2", "c3", "c4", "c5", "c6"), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return table(spark, d, "iniciativas_pa").select("registro_id", F.posexplode(c).alias("k", "committee")).select("registro_id", "committee", (F.col("k") + 1).alias("slot"))


@query()
def speaker_segments(spark: SparkSession, d: str) -> DataFrame:
    """Stretches of text from each speaker's mark to the next."""
    return docs.segments(table(spark, d, "documents"), "doc_id", "text", r"(PRESIDENCIA|SECRETARÍA):").select("doc_id", "position", "anchor", F.length("text").alias("chars"))


_SPEECH = "(?i)(?:la|el)\\s+(?:dip\\.|diputad[oa])\\s+((?:[A-ZÁÉÍÓÚÑ][0-9a-z_áéíóúñü]+\\s+)+)(?:present[óo]|propuso|solicit[óo])\\s+([^.;\\n]+)"


@query(f"""
    SELECT doc_id, trim(unnest(regexp_extract_all(text, '{_SPEECH}', 1))) AS presenter, trim(unnest(regexp_extract_all(text, '{_SPEECH}', 2))) AS subject FROM documents""")
def speeches(spark: SparkSession, d: str) -> DataFrame:
    """What deputies presented, proposed or asked for, by sentence."""
    return docs.speeches(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "presenter", "subject")


@query("""
    SELECT registro_id, k::INT AS position, CASE k WHEN 0 THEN 'item' WHEN 1 THEN 'floor' WHEN 4 THEN 'election' ELSE 'group' END AS grammar, CASE WHEN k = 0 AND registro_id % 2 = 0 THEN 'INICIATIVA DE DECRETO' ELSE 'PUNTO DE ACUERDO' END AS kind,
        CASE WHEN k = 0 THEN 'LA DIPUTADA EVA NUMERO ' || registro_id ELSE 'EVA SOL' END AS presenter, CASE k WHEN 0 THEN 'SE REFORMA LA LEY ' || registro_id WHEN 1 THEN 'SE EXHORTA A TODOS' WHEN 2 THEN 'SE PIDE LUZ' WHEN 3 THEN 'SE PIDE PAN' ELSE 'LA ELECCION DE LA MESA' END AS title,
        CASE k WHEN 0 THEN ['UNO', 'DOS', 'TRES', 'TREINTA Y UNO'][(registro_id % 4 + 1)::INT] ELSE 'AG' END AS point, CASE k WHEN 0 THEN 'COMISION DE SALUD' WHEN 2 THEN 'COMISION DE ENERGIA' WHEN 3 THEN 'COMISION DE ABASTO' END AS referral
    FROM iniciativas_pa, range(5) AS t(k)""")
def presentations(spark: SparkSession, d: str) -> DataFrame:
    """The items of minutes written from the records: one of each grammar, read back from the whole text."""
    i = F.col("registro_id")
    point = F.get(F.array(*[F.lit(w) for w in ("UNO", "DOS", "TRES", "TREINTA Y UNO")]), F.pmod(i, F.lit(4)).cast("int"))
    kind = F.when(F.pmod(i, F.lit(2)) == 0, "LA INICIATIVA DE DECRETO").otherwise("EL PUNTO DE ACUERDO")
    text = F.concat(
        F.lit("En el PUNTO "), point, F.lit(" DEL ORDEN DEL DÍA se dio\nlectura a "), kind, F.lit(" QUE PRESENTA LA DIPUTADA EVA NÚMERO "), i, F.lit(", POR EL QUE SE REFORMA LA LEY "), i,
        F.lit("; TURNÁNDOSE A LA COMISIÓN DE SALUD, PARA SU ESTUDIO. EN EL ÚLTIMO PUNTO DEL ORDEN DEL DÍA, ASUNTOS GENERALES. EN USO DE LA PALABRA LA DIPUTADA EVA SOL, PRESENTÓ EL PUNTO DE ACUERDO POR EL CUAL SE EXHORTA A TODOS; EN USO DE SU DERECHO. "),
        F.lit("PUNTOS DE ACUERDO PRESENTADOS POR EVA SOL, EN LOS TÉRMINOS SIGUIENTES: POR EL QUE SE PIDE LUZ, A LA COMISIÓN DE ENERGÍA, PARA SU ESTUDIO; Y EL QUE SE PIDE PAN, A LA COMISIÓN DE ABASTO. NO HABIENDO MÁS. "),
        F.lit("SE PROCEDIÓ A LA ELECCIÓN DE LA MESA; ACTO SEGUIDO, EN USO DE LA PALABRA LA DIPUTADA EVA SOL, PROPUSO."),
    )
    return docs.presentations(table(spark, d, "iniciativas_pa").select("registro_id", text.alias("text")), "registro_id", "text").drop("start")


# --- joins ------------------------------------------------------------------------------------------------------


@query("""
    WITH l AS (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS lines FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey AS k, o_totalprice AS total FROM orders)
    SELECT k, total, lines, CASE WHEN total IS NULL THEN 'only_right' WHEN lines IS NULL THEN 'only_left' WHEN total = lines THEN 'equal' ELSE 'different' END AS outcome FROM o FULL JOIN l USING (k)""")
def reconcile(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")), 2).cast("double").alias("lines"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total"))
    return joins.reconcile(o, li, ["k"], "total", "lines")


@query("""
    WITH v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts AS at, min(event_id) AS marker FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT event_id, marker FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.at""")
def asof_backward(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    p = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("at")).agg(F.min("event_id").alias("marker"))
    return joins.asof(e.where("event_type = 'view'").select("event_id", "user_id", "ts"), p, ["user_id"], "ts", "at", ["marker"]).select("event_id", "marker")


@query("""
    WITH v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), p AS (SELECT user_id, ts AS at, min(event_id) AS marker FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
    SELECT event_id, marker FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts <= p.at""")
def asof_forward(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    p = e.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("at")).agg(F.min("event_id").alias("marker"))
    return joins.asof(e.where("event_type = 'view'").select("event_id", "user_id", "ts"), p, ["user_id"], "ts", "at", ["marker"], forward=True).select("event_id", "marker")


@query("""
    WITH p AS (SELECT a.o_orderkey, b.o_orderkey AS earlier, b.o_totalprice AS score, row_number() OVER (PARTITION BY a.o_orderkey ORDER BY b.o_totalprice DESC, b.o_orderkey) AS rn
        FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderkey <> a.o_orderkey AND date_diff('day', b.o_orderdate::DATE, a.o_orderdate::DATE) BETWEEN 0 AND 150)
    SELECT o_orderkey, earlier, score FROM p WHERE rn = 1""")
def band_argmax(spark: SparkSession, d: str) -> DataFrame:
    """For each order, its customer's largest order of the 150 days before."""
    o = table(spark, d, "orders")
    a = o.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    b = o.select("o_custkey", F.col("o_orderkey").alias("earlier"), F.col("o_orderdate").cast("date").alias("day_b"), F.col("o_totalprice").alias("price"))
    p = joins.band_join(a, b, ["o_custkey"], "day", "day_b", 150).where("o_orderkey <> earlier")
    return joins.top_one(p, ["o_orderkey"], F.col("price"), ["earlier"]).select("o_orderkey", "earlier", "score")


@query("""
    SELECT l_orderkey, l_linenumber, p_partkey FROM lineitem JOIN part ON l_partkey = p_partkey AND l_quantity BETWEEN p_size - 5 AND p_size + 5""")
def range_match(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") - 5).alias("low"), (F.col("p_size") + 5).alias("high"))
    return joins.range_join(li, p, ["p_partkey"], "l_quantity", "low", "high", 10).select("l_orderkey", "l_linenumber", "p_partkey")


@query("""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY nombre ORDER BY folio_foto DESC, coalesce(partido, '') DESC) AS rn FROM perfiles), p AS (SELECT nombre, partido, folio_foto FROM r WHERE rn = 1)
    SELECT registro_id, presentador, folio_foto FROM iniciativas_pa LEFT JOIN p ON presentador = nombre""")
def join_last_wins(spark: SparkSession, d: str) -> DataFrame:
    p = joins.last_wins(table(spark, d, "perfiles").select("nombre", "partido", "folio_foto"), ["nombre"], "folio_foto")
    i = table(spark, d, "iniciativas_pa").select("registro_id", "presentador")
    return i.join(p.withColumnRenamed("nombre", "presentador"), "presentador", "left").select("registro_id", "presentador", "folio_foto")


@query("""
    WITH s AS (SELECT DISTINCT sesion_id, strptime(fecha, '%d/%m/%Y') AS day, tipo_de_sesion FROM sesiones WHERE fecha IS NOT NULL),
    v AS (SELECT DISTINCT votacion_id, try_strptime(fecha, '%d/%m/%y') AS day FROM votaciones WHERE fecha IS NOT NULL),
    j AS (SELECT v.votacion_id, s.sesion_id, row_number() OVER (PARTITION BY v.votacion_id ORDER BY CASE WHEN lower(s.tipo_de_sesion) = 'ordinaria' THEN 0 ELSE 1 END, s.sesion_id) AS rn FROM v LEFT JOIN s USING (day))
    SELECT votacion_id, sesion_id FROM j WHERE rn = 1""")
def session_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Each vote's session of the same day, an ordinary one first."""
    s = table(spark, d, "sesiones").select("sesion_id", cal.any_date("fecha").alias("day"), "tipo_de_sesion").where("day IS NOT NULL").distinct()
    v = table(spark, d, "votaciones").where("fecha IS NOT NULL").select("votacion_id", cal.any_date("fecha").alias("day")).distinct()
    return joins.lookup_with_tie_break(v, s, ["day"], "votacion_id", F.lower("tipo_de_sesion") == "ordinaria", ["sesion_id"]).select("votacion_id", "sesion_id")


@query("""SELECT d.doc_id, d.acta_id FROM documents d WHERE d.acta_id IS NULL OR NOT EXISTS (SELECT 1 FROM actas_extraidas_ia a WHERE a.acta_id = d.acta_id AND a.fecha_analisis >= TIMESTAMP '2024-01-01')""")
def pending_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose minutes no finished analysis covers."""
    a = table(spark, d, "actas_extraidas_ia").groupBy("acta_id").agg(F.bool_or(F.col("fecha_analisis") >= F.lit("2024-01-01").cast("timestamp_ntz")).alias("finished"), F.lit(1).alias("version"))
    return inc.pending(table(spark, d, "documents"), a, "acta_id").select("doc_id", "acta_id")


@query("""
    WITH n AS (SELECT registro_id, estatus FROM iniciativas_pa WHERE fecha_captura >= TIMESTAMP '2025-01-01'), o AS (SELECT registro_id, 'previo' AS estatus FROM iniciativas_pa)
    SELECT * FROM n UNION ALL SELECT * FROM o WHERE registro_id NOT IN (SELECT registro_id FROM n)""")
def upsert_new_wins(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "iniciativas_pa")
    n = i.where(F.col("fecha_captura") >= F.lit("2025-01-01").cast("timestamp_ntz")).select("registro_id", "estatus")
    return inc.upsert(i.select("registro_id", F.lit("previo").alias("estatus")), n, ["registro_id"])


@query("""
    WITH b AS (SELECT acta_id, CASE WHEN total IS NOT NULL THEN 'ok' ELSE 'error' END AS status, fecha_analisis AS seen, registro_id, 0 AS fresh FROM actas_extraidas_ia WHERE fecha_analisis < TIMESTAMP '2024-06-01' AND acta_id IS NOT NULL
        UNION ALL SELECT acta_id, CASE WHEN total IS NOT NULL THEN 'ok' ELSE 'error' END, fecha_analisis, registro_id, 1 FROM actas_extraidas_ia WHERE fecha_analisis >= TIMESTAMP '2024-06-01' AND acta_id IS NOT NULL),
    r AS (SELECT *, row_number() OVER (PARTITION BY acta_id ORDER BY (status = 'ok') DESC, fresh DESC, seen DESC, registro_id DESC) AS rn FROM b)
    SELECT acta_id, status, registro_id FROM r WHERE rn = 1""")
def upsert_never_worse(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "actas_extraidas_ia").where("acta_id IS NOT NULL").select("acta_id", F.when(F.col("total").isNotNull(), "ok").otherwise("error").alias("status"), F.col("fecha_analisis").alias("at"), "registro_id")
    cut_at = F.lit("2024-06-01").cast("timestamp_ntz")
    return inc.upsert_by_status(a.where(F.col("at") < cut_at), a.where(F.col("at") >= cut_at), "acta_id", "status", ["at", "registro_id"]).select("acta_id", "status", "registro_id")


@query("""SELECT count(*) AS total, count(*) FILTER (total IS NOT NULL) AS finished, count(tema_1) AS with_error, count(*) FILTER (total IS NULL) AS pending FROM actas_extraidas_ia""")
def status_summary(spark: SparkSession, d: str) -> DataFrame:
    return inc.status_summary(table(spark, d, "actas_extraidas_ia").select((F.col("total").isNotNull()).alias("finished"), F.col("tema_1").alias("error")), "finished", "error")


@query("""
    WITH a AS (SELECT registro_id, fecha, acta_id FROM actas_extraidas_ia), m AS (SELECT fecha, min(acta_id) AS first FROM a WHERE fecha IS NOT NULL GROUP BY 1) SELECT registro_id, first AS acta_id FROM a LEFT JOIN m USING (fecha)""")
def migrate_by_date(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "actas_extraidas_ia")
    return inc.migrate_by_date(a.select("registro_id", "fecha"), a.where("fecha IS NOT NULL").select("fecha", "acta_id"), "fecha", "acta_id").select("registro_id", "acta_id")


@query("""
    WITH p AS (SELECT folio_foto, max(correo) AS correo, max(twitter) AS twitter FROM perfiles GROUP BY 1), q AS (SELECT folio_foto, max(facebook) AS correo, max(casa_de_gestion) AS twitter FROM perfiles GROUP BY 1)
    SELECT p.folio_foto, coalesce(p.correo, q.correo) AS correo, coalesce(p.twitter, q.twitter) AS twitter FROM p LEFT JOIN q ON p.folio_foto = q.folio_foto""")
def priority_merge(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "perfiles").groupBy("folio_foto").agg(F.max("correo").alias("correo"), F.max("twitter").alias("twitter"), F.max("facebook").alias("f"), F.max("casa_de_gestion").alias("g"))
    return joins.coalesce_merge(p.select("folio_foto", "correo", "twitter"), [p.select("folio_foto", F.col("f").alias("correo"), F.col("g").alias("twitter"))], "folio_foto", ["correo", "twitter"])


_COMMITTEES = ["Pesca y Acuacultura", "Vivienda Digna", "Educación Básica y Superior", "Asuntos Electorales", "Hacienda Pública y Cuenta Municipal"]
_PHRASES = "|".join(["hacienda publica y cuenta municipal", "educacion basica y superior", "pesca y acuacultura", "asuntos electorales", "vivienda digna"])


@query(f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(strip_accents(text)), '\\b({_PHRASES})\\b', 1), lambda x, i: list_position(regexp_extract_all(lower(strip_accents(text)), '\\b({_PHRASES})\\b', 1), x) = i), ';') AS phrases FROM documents""")
def phrase_containment(spark: SparkSession, d: str) -> DataFrame:
    return joins.phrases_in(table(spark, d, "documents"), "doc_id", "text", _COMMITTEES).withColumn("phrases", F.array_join("phrases", ";"))


_SET = "list_distinct(regexp_extract_all(lower(strip_accents({0})), '[\\p{{L}}\\p{{Nd}}]+'))"


@query(f"""
    WITH c AS (SELECT comision_id, comision FROM cat_comisiones), v AS (SELECT DISTINCT c1 FROM iniciativas_pa WHERE c1 IS NOT NULL),
    w AS (SELECT c1, {_SET.format('c1')} AS a FROM v), k AS (SELECT comision_id, {_SET.format('comision')} AS b FROM c),
    wx AS (SELECT c1, a, unnest(a) AS word FROM w), kx AS (SELECT comision_id, b, unnest(b) AS word FROM k),
    p AS (SELECT DISTINCT c1, comision_id, a, b FROM wx JOIN kx USING (word) WHERE length(word) > 2),
    s AS (SELECT c1, comision_id, round(2.0 * len(list_intersect(a, b)) / (len(a) + len(b)), 9) AS score FROM p),
    r AS (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY score DESC, comision_id) AS rn FROM s)
    SELECT c1, comision_id, score FROM r WHERE rn = 1""")
def dice_top_one(spark: SparkSession, d: str) -> DataFrame:
    """The committee whose words are nearest to each typed value, of those that share a word."""
    v = table(spark, d, "iniciativas_pa").select("c1").where("c1 IS NOT NULL").distinct().withColumn("a", words("c1"))
    c = table(spark, d, "cat_comisiones").select("comision_id", words("comision").alias("b"))
    word = lambda x: F.explode(F.filter(x, lambda w: F.length(w) > 2)).alias("word")
    p = v.select("c1", "a", word("a")).join(c.select("comision_id", "b", word("b")), "word").drop("word").distinct()
    return joins.top_one(p, ["c1"], F.round(dice(F.col("a"), F.col("b")), 9), ["comision_id"]).select("c1", "comision_id", "score")


@query("""SELECT unnest(['partido', 'tema', 'c1']) AS "column", unnest([count(*) - count(partido), count(*) - count(tema), count(*) - count(c1)]) AS missing, count(*) AS rows FROM iniciativas_pa""")
def missing_by_column(spark: SparkSession, d: str) -> DataFrame:
    return quality.missing_by_column(table(spark, d, "iniciativas_pa"), ["partido", "tema", "c1"])


def _linkage(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(votes, candidate pairs, links): each vote and each earlier initiative of like text once, in order of time."""
    i = table(spark, d, "iniciativas_pa").select("registro_id", "descripcion", cal.any_date("fecha_pres").alias("day_i")).where("day_i IS NOT NULL AND descripcion IS NOT NULL")
    v = table(spark, d, "votaciones").select("votacion_id", F.col("descripcion").alias("texto"), cal.any_date("fecha").alias("day")).where("day IS NOT NULL").distinct()
    p = cut(candidate_links(v, "votacion_id", "day", "texto", i, "registro_id", "day_i", "descripcion", 0.3))
    return v, p, link_in_order(p, [], "day", "votacion_id", "registro_id", "similarity")


@query()
def vote_linkage(spark: SparkSession, d: str) -> DataFrame:
    """Votes linked to earlier initiatives of like text, each once, in order of time."""
    _, _, linked = _linkage(spark, d)
    return linked.select(cal.term_start("day").alias("term"), F.col("day").cast("string").alias("day"), "votacion_id", "registro_id", "similarity")


@query()
def vote_review(spark: SparkSession, d: str) -> DataFrame:
    """Votes whose link should be looked at: of low similarity, with a near tie, ambiguous, or without a link."""
    v, p, linked = _linkage(spark, d)
    return review_list(p, cut(linked), v, "votacion_id", "registro_id", "similarity")


@query()
def greedy_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Sessions and votes of a day paired one to one by their places."""
    s = table(spark, d, "sesiones").select("sesion_id", cal.any_date("fecha").alias("day")).distinct()
    v = table(spark, d, "votaciones").select("votacion_id", cal.any_date("fecha").alias("day"), "numero_votacion").distinct()
    p = s.join(v, "day").withColumn("similarity", 1.0 / (1 + F.abs(F.pmod("sesion_id", F.lit(7)) - F.col("numero_votacion")))).withColumn("score", F.col("similarity"))
    return joins.greedy_assignment(p, ["day"], "sesion_id", "votacion_id", "score", "similarity", 0.1, 0.05).withColumn("day", F.col("day").cast("string"))


@query()
def fuzzy_names(spark: SparkSession, d: str) -> DataFrame:
    """Names in roll calls looked up in the roster, as they are or nearly."""
    return joins.fuzzy_lookup(_votes(spark, d), table(spark, d, "perfiles"), "diputado", "nombre")


@query(f"""
    WITH w AS (SELECT registro_id, list_filter({_SET.format('titulo')}, lambda x: length(x) > 2) AS a, list_filter({_SET.format('tema')}, lambda x: length(x) > 2) AS b FROM actas_extraidas_ia WHERE titulo IS NOT NULL AND tema IS NOT NULL)
    SELECT registro_id, coalesce(len(list_intersect(a, b)) / nullif(len(list_distinct(list_concat(a, b))), 0), 0) AS jaccard, coalesce(len(list_intersect(a, b)) / nullif(least(len(a), len(b)), 0), 0) AS containment FROM w""")
def set_similarities(spark: SparkSession, d: str) -> DataFrame:
    """Every title with its topic, characters as they are; ``set_similarities_all`` brings them to one form first."""
    return _set_similarities(table(spark, d, "actas_extraidas_ia").where("titulo IS NOT NULL AND tema IS NOT NULL"))


@query()
def set_similarities_all(spark: SparkSession, d: str) -> DataFrame:
    """Every title with its topic, characters out of place first brought to one form."""
    r = table(spark, d, "actas_extraidas_ia").where("titulo IS NOT NULL AND tema IS NOT NULL")
    return _set_similarities(r.select("registro_id", canonical_form(F.col("titulo")).alias("titulo"), canonical_form(F.col("tema")).alias("tema")))


def _set_similarities(r: DataFrame) -> DataFrame:
    long = lambda c: F.filter(words(c), lambda w: F.length(w) > 2)
    r = r.select("registro_id", long("titulo").alias("a"), long("tema").alias("b"))
    return r.select("registro_id", jaccard(F.col("a"), F.col("b")).alias("jaccard"), containment(F.col("a"), F.col("b")).alias("containment"))


# --- fields -----------------------------------------------------------------------------------------------------


@query(f"""
    SELECT votacion_id, diputado, voto, CASE WHEN secret THEN 4 WHEN v = 'favor' THEN 1 WHEN v = 'contra' THEN 2 WHEN v = 'abstencion' THEN 3 ELSE 0 END AS code
    FROM (SELECT votacion_id, tipo_votacion = 'Cédula' AS secret, unnest(votaciones, max_depth := 2) FROM votaciones) x, LATERAL (SELECT trim(lower(strip_accents(voto))) AS v)""")
def vote_codes(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "votaciones").select("votacion_id", (F.col("tipo_votacion") == "Cédula").alias("secret"), F.explode("votaciones").alias("v"))
    return v.select("votacion_id", "v.diputado", "v.voto", records.vote_code(F.col("v.voto"), F.col("secret")).alias("code"))


@query("""
    SELECT registro_id, 41 - (coalesce(votos_f, 0) + coalesce(votos_c, 0) + coalesce(votos_a, 0)) AS absent, nullif(votos_c, 0) AS against, 100.0 * votos_f / nullif(votos_f + votos_c + votos_a, 0) AS percent FROM iniciativas_pa""")
def absences(spark: SparkSession, d: str) -> DataFrame:
    f, c, a = F.col("votos_f"), F.col("votos_c"), F.col("votos_a")
    return table(spark, d, "iniciativas_pa").select("registro_id", records.absences(f, c, a).alias("absent"), F.nullif(c, F.lit(0)).alias("against"), records.percent(f, f + c + a).alias("percent"))


@query("""
    SELECT folio_foto, nombre, CASE WHEN regexp_matches(t, '\\bdoctor(ado|a)?\\b') THEN 'Doctorado' WHEN regexp_matches(t, '\\bmaestr(ia|o|a)\\b') THEN 'Maestría' WHEN regexp_matches(t, '\\bpost?grado\\b') THEN 'Postgrado' WHEN regexp_matches(t, '\\bespecialidad\\b|\\bespecializacion\\b') THEN 'Especialidad'
        WHEN regexp_matches(t, '\\blicenciatura\\b|\\blicenciad[oa]\\b|^lic\\b') THEN 'Licenciatura' WHEN regexp_matches(t, '\\bingenier(ia|o|a)\\b') THEN 'Ingeniería' WHEN regexp_matches(t, '\\btecnic[oa] superior\\b|\\btsu\\b') THEN 'Técnico Superior' WHEN regexp_matches(t, '\\bbachillerato\\b|\\bpreparatoria\\b') THEN 'Bachillerato' END AS degree
    FROM (SELECT folio_foto, nombre, trim(lower(strip_accents(ultimo_grado_de_estudios))) AS t FROM perfiles)""")
def degrees(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "perfiles").select("folio_foto", "nombre", records.degree("ultimo_grado_de_estudios")["degree"].alias("degree"))


@query("""
    SELECT registro_id, CASE WHEN numero IS NULL THEN -1 WHEN numero % 10 = 0 THEN 1000000 WHEN numero % 10 = 1 THEN -1 ELSE numero END AS key FROM iniciativas_pa""")
def mixed_order(spark: SparkSession, d: str) -> DataFrame:
    """Agenda numbers as text, some of them the closing word, in their order."""
    n = F.when(F.pmod("numero", F.lit(10)) == 0, "AG").when(F.pmod("numero", F.lit(10)) == 1, "?").otherwise(F.col("numero").cast("string"))
    return table(spark, d, "iniciativas_pa").select("registro_id", records.mixed_key(n).alias("key")).orderBy("key")


@query("""
    SELECT comision_id, array_to_string(list_transform(string_split(lower(comision), ' '), lambda x, i: CASE WHEN i > 1 AND x IN ('de', 'del', 'la', 'las', 'los', 'y', 'e', 'en', 'a', 'al', 'con', 'por', 'para', 'el', 'que', 'se', 'o', 'u') THEN x ELSE upper(x[1]) || x[2:] END), ' ') AS title FROM cat_comisiones""")
def title_case(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cat_comisiones").select("comision_id", records.title_case(F.upper("comision")).alias("title"))


@query("""
    SELECT doc_id, regexp_matches(lower(strip_accents(text)), '(?m)^[^\\n]*\\bsolicit[^\\n]*$') AS asks, CASE WHEN acta_id IS NULL THEN NULL ELSE nullif(regexp_extract(acta_id, '(\\d+)$', 1), '') END AS number
    FROM documents""")
def line_predicate(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a line that asks for something, and the number in the id of their minutes."""
    url = F.concat(F.lit("https://x/acta_"), F.regexp_extract("acta_id", r"(\d+)$", 1))
    return table(spark, d, "documents").select("doc_id", records.any_line("text", r"\bsolicit").alias("asks"), records.document_id(url).alias("number"))


# The topic of each committee, the most frequent one of the records with both written as in their lists.
COMMITTEE_TOPICS = {
    "Hacienda Pública y Cuenta Municipal": 7, "Presupuesto, Deuda y Financiamiento": 7, "Salud y Asistencia Médica": 6, "Educación Básica y Superior": 8, "Cultura Popular y Artesanías": 8, "Ciencia, Innovación y Humanidades": 8, "Medio Natural y Acción Climática": 5, "Bosques, Aguas y Suelos": 5,
    "Desarrollo Rural Integral": 12, "Desarrollo Urbano y Ordenamiento": 11, "Desarrollo Económico y Fomento Industrial": 1, "Turismo y Hospitalidad": 1, "Comercio y Mercados Públicos": 1, "Vivienda Digna": 11, "Caminos, Puentes y Obras": 11, "Transporte y Movilidad Segura": 11,
    "Gobernación y Asuntos Constitucionales": 14, "Impartición de Justicia": 14, "Derechos Humanos y Víctimas": 14, "Seguridad Ciudadana": 3, "Protección Civil y Bomberos": 3, "Sistema Penitenciario": 3, "Asuntos Electorales": 4, "Partidos y Consultas Populares": 4,
    "Igualdad Sustantiva y Mujeres": 20, "Prevención de Violencia contra las Mujeres": 20, "Niñez y Adolescencia": 2, "Juventudes y Deporte": 8, "Personas Adultas Mayores": 2, "Personas con Discapacidad": 2, "Pueblos Originarios y Lenguas": 2, "Migrantes y Enlace Internacional": 9,
    "Trabajo y Seguridad Social": 16, "Transparencia y Datos Abiertos": 10, "Fiscalización y Combate a la Corrupción": 10, "Ganadería y Apicultura": 12, "Pesca y Acuacultura": 12, "Radio, Prensa y Difusión": 13, "Redes Digitales y Conectividad": 15, "Administración y Servicio Público": 18,
    "Asuntos Municipales y Metropolitanos": 18, "Adquisiciones y Arrendamientos": 18, "Reglamento y Prácticas Parlamentarias": 19, "Crónica, Biblioteca y Archivo": 19,
}


_TOPIC_MAP = "MAP {" + ", ".join(f"lower(strip_accents('{k}')): {v}" for k, v in COMMITTEE_TOPICS.items()) + "}"
_COMMITTEE = "trim(regexp_replace(lower(strip_accents(x)), '^(?:comision|comite) (?:de )?(?:la |las |los )?', ''))"


@query(f"""
    WITH t AS (SELECT registro_id, descripcion, list_filter(list_transform([c1, c2, c3, c4, c5, c6], lambda x: coalesce({_TOPIC_MAP}[{_COMMITTEE}], CASE WHEN {_COMMITTEE} LIKE 'agenda 2030%' THEN 5 END)), lambda t: t IS NOT NULL)[1] AS topic FROM iniciativas_pa),
    p AS (SELECT registro_id, CASE WHEN contains(lower(strip_accents(descripcion)), 'codigo penal') THEN 14 ELSE topic END AS topic FROM t)
    SELECT registro_id, topic IS NOT NULL AS known, topic FROM p""")
def topic_by_committee(spark: SparkSession, d: str, topics: dict[str, int] = COMMITTEE_TOPICS) -> DataFrame:
    """The topic of every record by its committees, with or without heading: that of the penal code where the text names
    it, else of the first committee that has one."""
    t = records.topic_of(F.array("c1", "c2", "c3", "c4", "c5", "c6"), topics, {"agenda 2030": 5})
    t = F.when(fold("descripcion").contains("codigo penal"), 14).otherwise(t)
    return table(spark, d, "iniciativas_pa").select("registro_id", t.isNotNull().alias("known"), t.alias("topic"))


topic_by_committee_all = QUERIES["topic_by_committee_all"] = topic_by_committee


@query("""
    SELECT legislatura, min(try_strptime(fecha_pres, '%d/%m/%y'))::DATE::VARCHAR AS oldest, max(length(descripcion))::INT AS longest, max(len(list_filter([c1, c2, c3, c4, c5, c6], lambda x: x IS NOT NULL)))::INT AS most_slots FROM iniciativas_pa GROUP BY 1""")
def extremes(spark: SparkSession, d: str) -> DataFrame:
    """Oldest date, longest text and longest list of each legislature."""
    n = F.size(F.filter(F.array("c1", "c2", "c3", "c4", "c5", "c6"), lambda x: x.isNotNull()))
    return table(spark, d, "iniciativas_pa").groupBy("legislatura").agg(F.min(cal.any_date("fecha_pres")).cast("string").alias("oldest"), F.max(F.length("descripcion")).alias("longest"), F.max(n).alias("most_slots"))


# --- streams ----------------------------------------------------------------------------------------------------


@query("""SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts by a stream over the event files, written to a table in the shared folder."""
    import uuid

    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    events = read_growing(spark, f"{d}/events.parque[t]", schema).withColumn("ts", F.col("ts").cast("timestamp"))
    run_to_table(window_counts(events, "ts", ["event_type"], "value", "1 hour", "60 days"), f"{out}/table", f"{out}/state")
    r = spark.read.parquet(f"{out}/table")
    return r.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
