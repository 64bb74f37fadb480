"""Further queries over the core's operators, each with its SQL: orders, guards, classifiers, dates, texts and review rules.

Inputs that the tables hold too rarely, such as broken records, are derived the same way in the query and in its SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curul.functions import calendar as cal
from curul.functions import classify, cleaning, records
from curul.functions.numbers_es import HUNDREDS, WORDS, words_of
from curul.functions.similarity import dice
from curul.functions.text import words
from curul.operators import documents as docs
from curul.operators import incremental as inc
from curul.operators import joins, numbering, ordering, quality
from curul.operators.linkage import review_list
from curul.queries import query
from curul.sources.tables import table

_Q = lambda items: ", ".join("'" + str(x).replace("'", "''") + "'" for x in items)
_FOLD = "lower(strip_accents({0}))"
_DATE = "coalesce(try_strptime({0}, '%d/%m/%y'), try_strptime({0}, '%d/%m/%Y'))::DATE"


# --- orders -----------------------------------------------------------------------------------------------------

_APPROVED = "try_strptime(fecha_aprobacion, '%d/%m/%y')::DATE"


@query(f"""
    SELECT registro_id, row_number() OVER (PARTITION BY legislatura ORDER BY {_APPROVED} ASC NULLS LAST, registro_id) AS dated_first,
        row_number() OVER (PARTITION BY legislatura ORDER BY {_APPROVED} DESC NULLS LAST, registro_id) AS newest_first,
        row_number() OVER (PARTITION BY legislatura ORDER BY coalesce(partido, ''), registro_id) AS missing_first,
        row_number() OVER (PARTITION BY legislatura ORDER BY {_APPROVED} ASC NULLS FIRST, numero ASC NULLS FIRST, registro_id) AS unread_first,
        row_number() OVER (PARTITION BY legislatura ORDER BY {_APPROVED} ASC NULLS FIRST, coalesce(votos_f, 0), coalesce(numero, 0), registro_id) AS three_levels,
        row_number() OVER (PARTITION BY legislatura ORDER BY registro_id DESC) AS reversed FROM iniciativas_pa""")
def orders_of_records(spark: SparkSession, d: str) -> DataFrame:
    """The place of each record in its legislature under six orders."""
    r = table(spark, d, "iniciativas_pa").withColumn("day", cal.any_date("fecha_aprobacion"))
    day, seq = F.col("day"), "registro_id"
    orders = {
        "dated_first": ordering.nulls_last(day, seq), "newest_first": ordering.nulls_last(day, seq, descending=True), "missing_first": ordering.missing_first(F.col("partido"), seq),
        "unread_first": ordering.unread_first(day, F.col("numero").asc_nulls_first(), F.col(seq).asc()), "three_levels": ordering.three_levels(day, F.col("votos_f"), F.col("numero"), seq), "reversed": ordering.reversed_input(seq),
    }
    return ordering.places(r, ["legislatura"], orders).select("registro_id", *orders)


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC NULLS LAST, l_linenumber DESC) AS place FROM lineitem""")
def candidates_in_order(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return ordering.places(li, ["l_orderkey"], {"place": ordering.best_first(F.col("l_quantity"), "l_linenumber")}).select("l_orderkey", "l_linenumber", "place")


@query("""SELECT user_id, event_type, count(*) AS n, string_agg(event_id::VARCHAR, ',' ORDER BY ts, event_id) AS ids FROM events GROUP BY 1, 2""")
def lists_by_group(spark: SparkSession, d: str) -> DataFrame:
    """The events of each user and type as one list in order of time."""
    e = table(spark, d, "events").withColumn("at", F.struct("ts", "event_id"))
    g = ordering.group_to_list(e, ["user_id", "event_type"], "event_id", "at")
    return g.select("user_id", "event_type", F.size("values").cast("bigint").alias("n"), F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("ids"))


# --- guards and predicates --------------------------------------------------------------------------------------


@query(f"""
    SELECT nombre, folio_foto, {_FOLD.format('trim(ultimo_grado_de_estudios)')} IN ('licenciatura', 'maestria') IS TRUE AS marked FROM perfiles
    WHERE nombre IS NOT NULL AND trim(nombre) <> '' AND correo IS NOT NULL AND trim(correo) <> ''""")
def guarded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Deputies with name and mail, and whether their degree is one of those to mark."""
    p = records.guarded(table(spark, d, "perfiles"), ["nombre", "correo"])
    return p.select("nombre", "folio_foto", records.is_one_of("ultimo_grado_de_estudios", ("Licenciatura", "Maestría")).alias("marked"))


@query("""
    SELECT 'permanente' AS part, count(*) AS n, count(DISTINCT fecha) AS days FROM sesiones WHERE lower(strip_accents(tipo_de_sesion)) LIKE '%extraordinaria%'
    UNION ALL SELECT 'otras', count(*), count(DISTINCT fecha) FROM sesiones WHERE lower(strip_accents(tipo_de_sesion)) NOT LIKE '%extraordinaria%' OR tipo_de_sesion IS NULL""")
def split_sessions(spark: SparkSession, d: str) -> DataFrame:
    a, b = records.split_by(table(spark, d, "sesiones"), classify.session_kind("tipo_de_sesion") == "Extraordinaria")
    part = lambda x, name: x.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.count_distinct("fecha").alias("days"))
    return part(a, "permanente").unionByName(part(b, "otras"))


@query("""SELECT doc_id, coalesce(regexp_matches(text, '(?i)unanimidad de votos|votos? a favor'), false) AS worth FROM documents""")
def vote_prefilter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", classify.tells_of_a_vote("text").alias("worth"))


@query("""
    SELECT registro_id, coalesce(length(t) <= 80 AND regexp_matches(t, '^[\\p{L}.'' -]+$') AND len(w) BETWEEN 2 AND 10 AND NOT list_has_any(w, ['sesion', 'lista', 'asistencia', 'total', 'presidencia', 'secretaria', 'orden']), false) AS valid
    FROM (SELECT registro_id, trim(presentador) AS t, string_split(regexp_replace(lower(strip_accents(trim(presentador))), '\\s+', ' ', 'g'), ' ') AS w FROM iniciativas_pa)""")
def valid_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "iniciativas_pa").select("registro_id", classify.person_name_valid("presentador").alias("valid"))


_LAW = "nullif(regexp_extract({0}, '((?:Ley|Código|Reglamento|Estatuto)(?: [A-Z][a-záéíóúñ]+)?) de', 1), '')"


@query(f"""
    SELECT registro_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN contains(a, b) OR contains(b, a) WHEN a IS NOT NULL AND coalesce(tipo = 'Punto de Acuerdo', false) THEN false ELSE true END AS fits
    FROM (SELECT registro_id, tipo, {_FOLD.format(_LAW.format('descripcion'))} AS a, CASE registro_id % 3 WHEN 0 THEN {_FOLD.format(_LAW.format('descripcion'))} WHEN 1 THEN 'ley de aguas' END AS b FROM iniciativas_pa)""")
def laws_that_fit(spark: SparkSession, d: str) -> DataFrame:
    """The law of each description against its own, another or none."""
    law = F.nullif(F.regexp_extract("descripcion", r"((?:Ley|Código|Reglamento|Estatuto)(?: [A-Z][a-záéíóúñ]+)?) de", 1), F.lit(""))
    k = F.pmod("registro_id", F.lit(3))
    other = F.when(k == 0, law).when(k == 1, "Ley de Aguas")
    return table(spark, d, "iniciativas_pa").select("registro_id", records.laws_compatible(law, other, F.coalesce(F.col("tipo") == "Punto de Acuerdo", F.lit(False))).alias("fits"))


_ERRORS = ["429 RESOURCE_EXHAUSTED\\nlimit: GenerateRequestsPerDay", "API key not valid. Pass one", "HTTP 429 slow down", "503 UNAVAILABLE", "Connection timed out", "Expecting value: line 1", "algo raro", "Intento 1: 503. Último error: ssl handshake"]
_ERROR_SQL = "[" + ", ".join("E'" + e + "'" for e in _ERRORS) + "]"


@query(f"""
    SELECT event_id, CASE WHEN regexp_matches(t, '\\b429\\b|resource_exhausted|quota') AND regexp_matches(t, 'per ?day') THEN 'cuota_diaria_agotada' WHEN regexp_matches(t, 'api key not valid|permission_denied|unauthenticated') THEN 'credenciales_invalidas'
        WHEN regexp_matches(t, '\\b429\\b|resource_exhausted|quota') THEN 'cuota_agotada' WHEN regexp_matches(t, '\\b50[0234]\\b|unavailable|overloaded|internal') THEN 'alta_demanda' WHEN regexp_matches(t, 'connect|timeout|timed out|network|ssl') THEN 'error_red'
        WHEN regexp_matches(t, 'json|expecting value|extra data') THEN 'respuesta_invalida' ELSE 'error_desconocido' END AS kind
    FROM (SELECT event_id, lower(regexp_replace({_ERROR_SQL}[(event_id % 8 + 1)::INT] || ' #' || event_id, '^.*Último error:', '')) AS t FROM events)""")
def error_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Texts of failures, some over several lines, by kind."""
    e = F.get(F.array(*[F.lit(x.replace("\\n", "\n")) for x in _ERRORS]), F.pmod("event_id", F.lit(8)).cast("int"))
    return table(spark, d, "events").select("event_id", classify.error_kind(F.concat(e, F.lit(" #"), F.col("event_id"))).alias("kind"))


@query("""SELECT event_id, 5.0 * pow(2, event_id % 6) AS wait, least(coalesce(CASE event_id % 3 WHEN 0 THEN event_id % 17 WHEN 1 THEN (event_id % 8) + 0.5 END, 5.0), 10.0)::DOUBLE AS asked FROM events""")
def waiting_times(spark: SparkSession, d: str) -> DataFrame:
    """Waits by the number of the attempt, and those that error texts ask for."""
    k = F.pmod("event_id", F.lit(3))
    text = F.when(k == 0, F.concat(F.lit("429 {'retryDelay': '"), F.pmod("event_id", F.lit(17)), F.lit("s'}"))).when(k == 1, F.concat(F.lit("Please retry in "), F.pmod("event_id", F.lit(8)), F.lit(".5s."))).otherwise("503")
    return table(spark, d, "events").select("event_id", records.backoff_seconds(F.pmod("event_id", F.lit(6)) + 1).alias("wait"), records.retry_delay(text).alias("asked"))


@query("""SELECT count(*) FILTER (event_id > 5000) AS rows_after, count(*) FILTER (event_id > 5000 AND event_type = 'error') AS pending_after FROM events""")
def pending_after_stop(spark: SparkSession, d: str) -> DataFrame:
    return inc.pending_after(table(spark, d, "events"), "event_id", 5000, F.col("event_type") == "error")


# --- classifiers and names --------------------------------------------------------------------------------------


@query("""
    WITH t AS (SELECT sesion_id, tipo_de_sesion, lower(strip_accents(tipo_de_sesion)) AS t FROM sesiones),
    k AS (SELECT *, CASE WHEN t LIKE '%comision permanente%' THEN 'comision permanente' WHEN t LIKE '%solemne%' THEN 'solemne' WHEN t LIKE '%extraordinaria%' THEN 'extraordinaria' WHEN t LIKE '%previa%' THEN 'previa' WHEN t LIKE '%ordinaria%' THEN 'ordinaria' END AS k FROM t)
    SELECT sesion_id, CASE k WHEN 'comision permanente' THEN 'Comisión Permanente' WHEN 'ordinaria' THEN 'Pública Ordinaria' ELSE coalesce(upper(k[1]) || k[2:], regexp_replace(trim(tipo_de_sesion), '\\s+', ' ', 'g')) END AS public_kind,
        replace(coalesce(k, nullif(trim(regexp_replace(t, '\\s+', ' ', 'g')), ''), 'desconocida'), ' ', '-') AS kind_key FROM k""")
def session_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sesiones").select("sesion_id", classify.session_kind_public("tipo_de_sesion").alias("public_kind"), classify.session_kind_key("tipo_de_sesion").alias("kind_key"))


_SUBJECTS = [("salud", "Salud"), ("educacion", "Educación"), ("seguridad", "Seguridad"), ("agua", "Agua"), ("municipio", "Municipios"), ("presupuesto", "Presupuesto")]


@query(f"""
    SELECT doc_id, array_to_string(list_transform(list_sort(list_filter([{', '.join(f"{{'at': strpos(t, '{p}'), 'label': '{v}'}}" for p, v in _SUBJECTS)}], lambda x: x.at > 0)), lambda x: x.label), ',') AS subjects
    FROM (SELECT doc_id, {_FOLD.format('text')} AS t FROM documents)""")
def subjects_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Which of six subjects a document names, by first mention."""
    return table(spark, d, "documents").select("doc_id", F.array_join(classify.detect_in_order("text", _SUBJECTS), ",").alias("subjects"))


@query("""
    SELECT doc_id, n, item, CASE WHEN regexp_matches(f, '^lectura d(e la|e las|el|e los)\\s+(iniciativas?|proyectos? de decreto|minuta)') THEN 'Iniciativa' WHEN regexp_matches(f, '^lectura d(el|e los)\\s+puntos? de acuerdo') THEN 'Punto de Acuerdo'
        WHEN regexp_matches(f, '^lectura d(el|e los)\\s+acuerdos?\\b') THEN 'Acuerdo' WHEN regexp_matches(f, '^lectura d(el|e los)\\s+dictamen(es)?\\b') THEN 'Dictamen' WHEN regexp_matches(f, '^lectura d(e los|el)\\s+oficios?\\b') THEN 'Oficios' END AS kind
    FROM (SELECT doc_id, n, item, trim(lower(strip_accents(item))) AS f FROM (SELECT doc_id, generate_subscripts(i, 1)::INT - 1 AS n, unnest(i) AS item FROM (SELECT doc_id, regexp_extract_all(text, '\\d{1,3}\\. ([A-Z][^\\n.]+)', 1) AS i FROM documents)))""")
def agenda_items(spark: SparkSession, d: str) -> DataFrame:
    """Numbered items of documents and the kind that their beginning tells."""
    i = table(spark, d, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\d{1,3}\. ([A-Z][^\n.]+)"), F.lit(1))).alias("n", "item"))
    return i.select("doc_id", "n", "item", docs.item_kind(F.col("item")).alias("kind"))


@query("""
    SELECT registro_id, CASE len(c) WHEN 0 THEN '' WHEN 1 THEN c[1] ELSE array_to_string(c[:-2], ', ') || ' y ' || c[-1] END AS listed
    FROM (SELECT registro_id, list_filter([c1, c2, c3, c4, c5, c6], lambda x: x IS NOT NULL) AS c FROM iniciativas_pa)""")
def listed_committees(spark: SparkSession, d: str) -> DataFrame:
    c = F.filter(F.array("c1", "c2", "c3", "c4", "c5", "c6"), lambda x: x.isNotNull())
    return table(spark, d, "iniciativas_pa").select("registro_id", cleaning.join_with_y(c).alias("listed"))


@query("""
    WITH n AS (SELECT comision_id, left(trim(regexp_replace(CASE WHEN comision_id % 2 = 0 THEN left(comision, 9) ELSE comision END, '[\\[\\]:*?/\\\\]', ' ', 'g')), 31) AS name FROM cat_comisiones),
    r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY comision_id) AS k FROM n)
    SELECT comision_id, CASE WHEN k = 1 THEN name ELSE left(name, 31 - length(' (' || k || ')')) || ' (' || k || ')' END AS sheet FROM r""")
def sheet_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of sheets, unlike one another; half of them cut short so that some meet."""
    c = table(spark, d, "cat_comisiones").withColumn("name", F.when(F.pmod("comision_id", F.lit(2)) == 0, F.substring("comision", 1, 9)).otherwise(F.col("comision")))
    return records.unique_names(c, "name", "comision_id").select("comision_id", "sheet")


@query("""
    SELECT comision_id, replace(upper(t[1]) || t[2:], 'pueblos originarios', 'Pueblos Originarios') AS sentence FROM (SELECT comision_id, lower(comision) AS t FROM cat_comisiones)""")
def sentence_case(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cat_comisiones").select("comision_id", records.sentence_case(F.upper("comision"), ("Pueblos Originarios",)).alias("sentence"))


@query("""
    WITH p AS (SELECT legislatura, fecha_aprobacion, c1, try_strptime(fecha_pres, '%d/%m/%y')::DATE AS day, trim(presentador) AS who FROM iniciativas_pa WHERE fecha_aprobacion IS NOT NULL AND c1 IS NOT NULL AND presentador IS NOT NULL AND try_strptime(fecha_pres, '%d/%m/%y') IS NOT NULL),
    n AS (SELECT *, day(day) || '.' || month(day) || '.' || strftime(day, '%y') || ' ' || CASE WHEN regexp_matches(lower(strip_accents(who)), 'titular|comisi|junta|camara|presidente|ayuntamiento|congreso|municipal|coordinador|fiscal|tribunal|auditor|poder|secretar') THEN who ELSE split_part(who, ' ', 1) END AS part FROM p),
    g AS (SELECT legislatura, fecha_aprobacion, c1, list(part ORDER BY day, who) AS l FROM n GROUP BY 1, 2, 3)
    SELECT legislatura, fecha_aprobacion, c1, CASE WHEN len(l) > 1 THEN 'Concentrada: ' || array_to_string(l[:-2], ', ') || ' y ' || l[-1] END AS note FROM g""")
def grouped_notes(spark: SparkSession, d: str) -> DataFrame:
    """The note that tells which initiatives one approval took together: those of a day and a committee."""
    r = table(spark, d, "iniciativas_pa").select("legislatura", "fecha_aprobacion", "c1", cal.any_date("fecha_pres").alias("day"), F.trim("presentador").alias("presenter")).dropna()
    g = r.groupBy("legislatura", "fecha_aprobacion", "c1").agg(F.collect_list(F.struct("day", "presenter")).alias("items"))
    return g.select("legislatura", "fecha_aprobacion", "c1", records.joined_note(F.col("items")).alias("note"))


# --- dates, times and numbers in words --------------------------------------------------------------------------

_MONTHS = "[" + _Q(cal.MONTHS) + "]"
_WORDS = "[" + _Q(WORDS) + "]"
_HUNDREDS = "[" + _Q(["ciento", *HUNDREDS[1:]]) + "]"


@query(f"""
    SELECT o_orderkey, CASE WHEN year(d) <> 2000 THEN strftime(d, '%Y-%m-%d') END AS day,
        'el ' || {_WORDS}[day(d) + 1] || ' de ' || {_MONTHS}[month(d)] || ' de ' || CASE WHEN year(d) < 2000 THEN 'mil novecientos ' || {_WORDS}[year(d) - 1900 + 1] WHEN year(d) = 2000 THEN 'dos mil' ELSE 'dos mil ' || {_WORDS}[year(d) - 2000 + 1] END AS phrase FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
def date_words(spark: SparkSession, d: str) -> DataFrame:
    """Order dates wholly in words, in capitals and inside a sentence, and read from there; "dos mil" alone is no year."""
    o = table(spark, d, "orders").select("o_orderkey", cal.words_date(F.col("o_orderdate").cast("date")).alias("phrase"))
    sentence = F.concat(F.lit("SESIÓN CELEBRADA "), F.upper("phrase"), F.lit(", A LAS DIEZ HORAS"))
    return o.select("o_orderkey", cal.date_of_words(sentence).cast("string").alias("day"), "phrase")


@query(f"""
    SELECT o_orderkey, strftime(d, '%d/%m/%y') AS slashes, strftime(d, '%d/%m/%Y') AS slashes4, day(d) || '.' || month(d) || '.' || strftime(d, '%y') AS dots, day(d) || ' de ' || {_MONTHS}[month(d)] || ' de ' || year(d) AS prose,
        CASE WHEN md BETWEEN 115 AND 514 THEN 'Segundo' WHEN md BETWEEN 515 AND 914 THEN 'Tercer' ELSE 'Primer' END || CASE WHEN md BETWEEN 915 AND 1215 OR md BETWEEN 115 AND 315 OR md BETWEEN 515 AND 715 THEN ' Periodo Ordinario' ELSE ' Receso' END AS title
    FROM (SELECT o_orderkey, d, month(d) * 100 + day(d) AS md FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders))""")
def dates_shown(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return o.select("o_orderkey", *[cal.format_date("d", f).alias(f) for f in ("slashes", "slashes4", "dots", "prose")], cal.period_title("d").alias("title"))


@query("""
    SELECT registro_id, CASE WHEN d >= DATE '2024-09-15' AND d < DATE '2025-09-15' THEN 'Primero' WHEN d >= DATE '2025-09-15' AND d < DATE '2026-09-15' THEN 'Segundo' WHEN d >= DATE '2026-09-15' AND d < DATE '2027-09-15' THEN 'Tercero' ELSE 'N/A' END AS label,
        CASE WHEN d >= DATE '2021-09-10' AND d < DATE '2022-09-10' THEN 'Primero' WHEN d >= DATE '2022-09-10' AND d < DATE '2023-09-10' THEN 'Segundo' WHEN d >= DATE '2023-09-10' AND d < DATE '2024-09-10' THEN 'Tercero' ELSE '-' END AS earlier
    FROM (SELECT registro_id, try_strptime(fecha_pres, '%d/%m/%y')::DATE AS d FROM iniciativas_pa)""")
def year_labels(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "iniciativas_pa").select("registro_id", cal.any_date("fecha_pres").alias("d"))
    return r.select("registro_id", cal.year_label("d", "2024-09-15").alias("label"), cal.year_label("d", "2021-09-10", "-").alias("earlier"))


_H12 = "(split_part(hora_de_cita, ':', 1)::INT % 12 + CASE WHEN hora_de_cita LIKE '%p.m.%' THEN 12 ELSE 0 END) * 3600 + split_part(hora_de_cita, ':', 2)::INT * 60 + substr(split_part(hora_de_cita, ':', 3), 1, 2)::INT"
_H24 = "(split_part({0}, ':', 1)::INT * 3600 + split_part({0}, ':', 2)::INT * 60 + split_part({0}, ':', 3)::INT)"


@query(f"""
    WITH t AS (SELECT DISTINCT sesion_id, CASE WHEN sesion_id % 4 <> 0 THEN {_H12} + CASE WHEN sesion_id % 5 = 0 THEN 3600 ELSE 0 END END AS c, CASE WHEN sesion_id % 6 <> 0 THEN {_H24.format('inicio_de_sesion')} END AS b FROM sesiones),
    e AS (SELECT *, coalesce(c, b // 3600 * 3600) AS called FROM t)
    SELECT sesion_id, called::INT AS called, c IS NULL AND b IS NOT NULL AS estimated, CASE WHEN c IS NULL AND b IS NOT NULL THEN 'La hora de cita es una estimación' WHEN c IS NULL THEN 'Hora de cita no disponible' END AS note,
        printf('%02d:%02d:%02d %s', (called // 3600 + 11) % 12 + 1, called % 3600 // 60, called % 60, CASE WHEN called < 43200 THEN 'a.m.' ELSE 'p.m.' END) AS shown,
        CASE WHEN b < called THEN '-' ELSE '' END || printf('%d:%02d:%02d', abs(b - called) // 3600, abs(b - called) % 3600 // 60, abs(b - called) % 60) AS delay FROM e""")
def called_times(spark: SparkSession, d: str) -> DataFrame:
    """Times called for, estimated where unknown, and the delay with its sign; some of both times taken away."""
    k = lambda n: F.pmod("sesion_id", F.lit(n)) == 0
    s = table(spark, d, "sesiones").select("sesion_id", F.when(~k(4), cal.seconds_of_day("hora_de_cita") + F.when(k(5), 3600).otherwise(0)).alias("c"), F.when(~k(6), cal.seconds_of_day("inicio_de_sesion")).alias("b")).distinct()
    e = s.withColumn("e", cal.called_or_estimated("c", "b")).select("sesion_id", "e.*", "b")
    return e.select("sesion_id", "called", "estimated", "note", cal.clock("called", 12).alias("shown"), cal.span(cal.delay_seconds("called", "b"), signed=True).alias("delay"))


@query(f"""
    SELECT DISTINCT sesion_id, b // 60 * 60 AS opened, f // 60 * 60 AS closed FROM (SELECT sesion_id, {_H24.format('inicio_de_sesion')} AS b, {_H24.format('fin_de_sesion')} AS f FROM sesiones)""")
def session_hours(spark: SparkSession, d: str) -> DataFrame:
    """Times of opening and closing read from the sentences in which minutes tell them."""
    s = table(spark, d, "sesiones").select("sesion_id", cal.seconds_of_day("inicio_de_sesion").alias("b"), cal.seconds_of_day("fin_de_sesion").alias("f")).distinct()
    told = lambda c: F.concat(F.lit("SIENDO LAS "), F.upper(words_of(F.floor(F.col(c) / 3600))), F.lit(" HORAS CON "), F.upper(words_of(F.floor(F.pmod(c, F.lit(3600)) / 60))), F.lit(" MINUTOS"))
    opened = F.concat(F.lit("HUBO QUÓRUM Y SE ABRIÓ LA SESIÓN ORDINARIA, "), told("b"), F.lit("."))
    text = F.concat_ws(" ", opened, F.lit("SE DIO LECTURA AL ACTA."), F.concat(F.lit("LA PRESIDENCIA LEVANTÓ LA SESIÓN\n"), told("f"), F.lit(" DEL DÍA.")))
    h = docs.session_hours(text)
    return s.select("sesion_id", h["opened"].cast("bigint").alias("opened"), h["closed"].cast("bigint").alias("closed"))


@query(f"""
    SELECT l_orderkey, l_linenumber, n::INT AS n, CASE WHEN n < 100 THEN {_WORDS}[n + 1] WHEN n = 100 THEN 'cien' WHEN n % 100 = 0 THEN {_HUNDREDS}[n // 100] ELSE {_HUNDREDS}[n // 100] || ' ' || {_WORDS}[n % 100 + 1] END AS phrase
    FROM (SELECT l_orderkey, l_linenumber, ((l_orderkey * 7 + l_linenumber * 131) % 1000)::INT AS n FROM lineitem)""")
def number_words(spark: SparkSession, d: str) -> DataFrame:
    from curul.functions.numbers_es import number_of

    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", words_of(F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131, F.lit(1000))).alias("phrase"))
    return li.select("l_orderkey", "l_linenumber", number_of(F.upper("phrase")).alias("n"), "phrase")


# --- projections and shapes -------------------------------------------------------------------------------------


@query("""SELECT coalesce(partido, 'sin partido') AS siglas, nombre, coalesce(correo, 'N/A') AS correo, 0 AS version FROM perfiles""")
def projected_records(spark: SparkSession, d: str) -> DataFrame:
    """Columns renamed by their normalised names, private ones dropped, others filled from defaults."""
    p = table(spark, d, "perfiles").select(F.col("nombre").alias("Nombre"), F.col("partido").alias("Pártido "), F.col("correo").alias("CORREO"), F.col("folio_foto").alias("_folio"))
    p = cleaning.rename_by_key(cleaning.without_private(p), {"nombre": "nombre", "partido": "siglas", "correo": "correo"})
    return records.with_defaults(p, {"siglas": F.lit("sin partido"), "nombre": F.lit(None), "correo": F.lit("N/A"), "version": F.lit(0)})


@query("""SELECT event_id, to_json({'user_id': user_id, 'event_type': event_type}) AS cell FROM events""")
def nested_cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", records.cell_text(F.struct("user_id", "event_type")).alias("cell"))


@query("""
    WITH e AS (SELECT user_id, event_id, ts, event_type, event_type = 'purchase' AS closed FROM events),
    f AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 AND NOT coalesce(lag(closed) OVER w, true) THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    c AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS chain FROM f)
    SELECT user_id, chain::BIGINT AS chain, event_type, string_agg(event_id::VARCHAR, chr(10) ORDER BY ts, event_id) AS text, count(*) AS fragments FROM c GROUP BY 1, 2, 3""")
def joined_fragments(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive events of a type as fragments of one list, until one that closes it."""
    e = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", (F.col("event_type") == "purchase").alias("closed"), F.col("event_id").cast("string").alias("text"))
    return numbering.merge_fragments(e, ["user_id"], ["ts", "event_id"], ["event_type"], "closed", "text").select("user_id", "chain", "event_type", "text", "fragments")


_NULLS = _Q(cleaning.NULL_WORDS)
_SNIFFED = ["fecha", "hora_de_cita", "numero_de_sesion", "sesion_letra", "fecha_gaceta_parlamentaria", "retraso", "porcentaje_abordados", "duracion", "observaciones"]
_IS_DATE = "try_strptime(trim(v), '%d/%m/%Y') IS NOT NULL OR try_strptime(trim(v), '%d/%m/%y') IS NOT NULL OR try_strptime(trim(v), '%Y-%m-%d') IS NOT NULL OR try_cast(CASE WHEN regexp_matches(trim(v), '^\\d{5}(\\.0+)?$') THEN v END AS DOUBLE) BETWEEN 20000 AND 80000"
_IS_TIME = "regexp_matches(lower(trim(v)), '^([01]?\\d|2[0-3]):[0-5]\\d(:[0-5]\\d)?(\\s*[ap]\\.?\\s*m\\.?)?$')"


@query(" UNION ALL ".join(f"""
    SELECT '{c}' AS "column", CASE WHEN count(v) = 0 THEN 'empty' WHEN bool_and({_IS_DATE}) THEN 'date' WHEN bool_and({_IS_TIME}) THEN 'time' WHEN bool_and(try_cast(trim(v) AS DOUBLE) IS NOT NULL) THEN 'number' ELSE 'text' END AS kind, count(v) AS known
    FROM (SELECT CASE WHEN lower(trim({c}::VARCHAR)) NOT IN ({_NULLS}) THEN {c}::VARCHAR END AS v FROM sesiones) WHERE v IS NOT NULL""" for c in _SNIFFED))
def column_sniff(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.sniff_columns(table(spark, d, "sesiones"), _SNIFFED)


# --- review rules over records some of which were broken --------------------------------------------------------

_BROKEN = """(SELECT registro_id, CASE registro_id % 9 WHEN 0 THEN 'Aprobada' ELSE estatus END AS estatus, fecha_pres, CASE registro_id % 7 WHEN 0 THEN NULL WHEN 1 THEN coalesce(fecha_aprobacion, '01/02/27') ELSE fecha_aprobacion END AS fecha_aprobacion,
    CASE registro_id % 5 WHEN 0 THEN -dias_aprobacion WHEN 1 THEN dias_aprobacion + 400 ELSE dias_aprobacion END AS dias_aprobacion, CASE WHEN registro_id % 11 <> 0 THEN votos_f END AS votos_f, CASE registro_id % 13 WHEN 0 THEN '77' ELSE tema END AS tema FROM iniciativas_pa)"""


@query(f"""
    WITH b AS {_BROKEN}, r AS (SELECT registro_id, unnest([CASE WHEN dias_aprobacion < 0 THEN 'negative_days' END, CASE WHEN estatus = 'Aprobada' AND fecha_aprobacion IS NULL THEN 'approved_without_date' END,
        CASE WHEN estatus <> 'Aprobada' AND fecha_aprobacion IS NOT NULL THEN 'date_without_approval' END, CASE WHEN dias_aprobacion > 365 THEN 'over_a_year' END, CASE WHEN estatus = 'Aprobada' AND votos_f IS NULL THEN 'approved_without_votes' END,
        CASE WHEN dias_aprobacion <> date_diff('day', try_strptime(fecha_pres, '%d/%m/%y'), try_strptime(fecha_aprobacion, '%d/%m/%y')) THEN 'days_differ' END,
        CASE WHEN try_cast(tema AS INT) IS NOT NULL AND try_cast(tema AS INT) NOT IN (SELECT tema_id FROM cat_temas) THEN 'topic_unknown' END]) AS rule FROM b)
    SELECT registro_id, rule FROM r WHERE rule IS NOT NULL""")
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of approvals, days, votes and topics over records of which some were broken on purpose."""
    k = lambda n, v: F.pmod("registro_id", F.lit(n)) == v
    days = F.col("dias_aprobacion")
    b = table(spark, d, "iniciativas_pa").select(
        "registro_id", F.when(k(9, 0), "Aprobada").otherwise(F.col("estatus")).alias("estatus"), "fecha_pres", F.when(k(7, 0), None).when(k(7, 1), F.coalesce("fecha_aprobacion", F.lit("01/02/27"))).otherwise(F.col("fecha_aprobacion")).alias("fecha_aprobacion"),
        F.when(k(5, 0), -days).when(k(5, 1), days + 400).otherwise(days).alias("days"), F.when(~k(11, 0), F.col("votos_f")).alias("votos_f"), F.when(k(13, 0), "77").otherwise(F.col("tema")).alias("tema"),
    )
    known = [str(r[0]) for r in table(spark, d, "cat_temas").select("tema_id").limit(10_001).collect()]
    if len(known) > 10_000:
        raise ValueError("over 10000 topics")
    approved, gap = F.col("estatus") == "Aprobada", F.datediff(cal.any_date("fecha_aprobacion"), cal.any_date("fecha_pres"))
    return quality.violations(b, ["registro_id"], {
        "negative_days": F.col("days") < 0, "approved_without_date": approved & F.col("fecha_aprobacion").isNull(), "date_without_approval": ~approved & F.col("fecha_aprobacion").isNotNull(), "over_a_year": F.col("days") > 365,
        "approved_without_votes": approved & F.col("votos_f").isNull(), "days_differ": F.col("days") != gap, "topic_unknown": F.col("tema").try_cast("int").isNotNull() & ~F.col("tema").try_cast("int").cast("string").isin(known),
    })


@query(f"""
    WITH t AS (SELECT DISTINCT sesion_id, {_H12} AS c, {_H24.format('inicio_de_sesion')} + CASE sesion_id % 5 WHEN 0 THEN -7200 WHEN 1 THEN 14400 ELSE 0 END AS b, {_H24.format('fin_de_sesion')} - CASE sesion_id % 6 WHEN 0 THEN 36000 ELSE 0 END AS f,
        asuntos_programados - CASE sesion_id % 7 WHEN 0 THEN asuntos_programados WHEN 1 THEN 4 ELSE 0 END AS p, asuntos_abordados AS a FROM sesiones),
    r AS (SELECT sesion_id, unnest([CASE WHEN f < b THEN 'ended_before_begun' END, CASE WHEN b < c THEN 'begun_before_called' END, CASE WHEN b - c > 10800 THEN 'very_late' END, CASE WHEN a > p THEN 'more_done_than_planned' END, CASE WHEN p = 0 THEN 'nothing_planned' END]) AS rule FROM t)
    SELECT sesion_id, rule FROM r WHERE rule IS NOT NULL""")
def broken_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Rules of the times and the agenda of sessions, some of which were broken on purpose."""
    k = lambda n, v: F.pmod("sesion_id", F.lit(n)) == v
    s = table(spark, d, "sesiones").select(
        "sesion_id", cal.seconds_of_day("hora_de_cita").alias("c"), (cal.seconds_of_day("inicio_de_sesion") + F.when(k(5, 0), -7200).when(k(5, 1), 14400).otherwise(0)).alias("b"), (cal.seconds_of_day("fin_de_sesion") - F.when(k(6, 0), 36000).otherwise(0)).alias("f"),
        (F.col("asuntos_programados") - F.when(k(7, 0), F.col("asuntos_programados")).when(k(7, 1), 4).otherwise(0)).alias("p"), F.col("asuntos_abordados").alias("a"),
    ).distinct()
    c, b, f, p, a = (F.col(x) for x in "cbfpa")
    return quality.violations(s, ["sesion_id"], {"ended_before_begun": f < b, "begun_before_called": b < c, "very_late": b - c > 180 * 60, "more_done_than_planned": a > p, "nothing_planned": p == 0})


@query("""
    WITH s AS (SELECT DISTINCT sesion_id, porcentaje_abordados + CASE sesion_id % 3 WHEN 0 THEN 0.5 ELSE 0 END AS p, coeficiente_abordados + CASE sesion_id % 4 WHEN 0 THEN 0.01 ELSE 0 END AS c, retraso_minutos + CASE sesion_id % 5 WHEN 0 THEN 3 ELSE 0 END AS r,
        asuntos_abordados / nullif(asuntos_programados, 0)::DOUBLE AS share, split_part(retraso, ':', 1)::INT * 60 + split_part(retraso, ':', 2)::INT AS m FROM sesiones),
    f AS (SELECT sesion_id, unnest([{'field': 'porcentaje', 'stored': p, 'computed': 100 * share, 'most': 0.06}, {'field': 'coeficiente', 'stored': c, 'computed': share, 'most': 0.0006}, {'field': 'retraso', 'stored': r, 'computed': m, 'most': 0.5}], max_depth := 2) FROM s)
    SELECT sesion_id, field, round(stored::DOUBLE, 6) AS stored, round(computed::DOUBLE, 6) AS computed FROM f WHERE (stored IS NULL) <> (computed IS NULL) OR abs(stored - computed) > most""")
def stored_derived(spark: SparkSession, d: str) -> DataFrame:
    """Stored derived values against computed ones, each with its tolerance, some moved on purpose."""
    k = lambda n: F.pmod("sesion_id", F.lit(n)) == 0
    share = F.try_divide("asuntos_abordados", "asuntos_programados")
    checks = {
        "porcentaje": (F.col("porcentaje_abordados") + F.when(k(3), 0.5).otherwise(0.0), 100 * share, 0.06), "coeficiente": (F.col("coeficiente_abordados") + F.when(k(4), 0.01).otherwise(0.0), share, 0.0006),
        "retraso": (F.col("retraso_minutos") + F.when(k(5), 3).otherwise(0), F.floor(cal.seconds_of_duration("retraso") / 60), 0.5),
    }
    r = quality.stored_against_computed(table(spark, d, "sesiones").drop("observaciones").distinct(), ["sesion_id"], checks)
    return r.select("sesion_id", "field", F.round("stored", 6).alias("stored"), F.round("computed", 6).alias("computed"))


@query("""
    WITH o AS (SELECT DISTINCT votacion_id, a_favor + CASE votacion_id % 4 WHEN 0 THEN 1 ELSE 0 END AS stored, len(list_filter(votaciones, lambda v: lower(strip_accents(v.voto)) LIKE '%favor%')) AS counted FROM votaciones)
    SELECT votacion_id, stored::BIGINT AS stored, counted FROM o WHERE stored <> counted""")
def declared_totals(spark: SparkSession, d: str) -> DataFrame:
    """Stored numbers in favour against the ballots, a quarter of them moved by one."""
    n = F.size(F.filter("votaciones", lambda b: classify.vote_kind(b["voto"]) == "favor")).cast("bigint")
    v = table(spark, d, "votaciones").select("votacion_id", (F.col("a_favor") + F.when(F.pmod("votacion_id", F.lit(4)) == 0, 1).otherwise(0)).cast("bigint").alias("stored"), n.alias("counted")).distinct()
    return v.where("stored <> counted")


@query(f"""
    WITH v AS (SELECT c1, list_distinct(regexp_extract_all(lower(strip_accents(c1)), '[\\p{{L}}\\p{{Nd}}]+')) AS a FROM (SELECT DISTINCT c1 FROM iniciativas_pa WHERE c1 IS NOT NULL)),
    c AS (SELECT comision_id, list_distinct(regexp_extract_all(lower(strip_accents(comision)), '[\\p{{L}}\\p{{Nd}}]+')) AS b FROM cat_comisiones),
    p AS (SELECT c1, comision_id, round(2 * len(list_intersect(a, b)) / (len(a) + len(b)), 9) AS s FROM v, c WHERE list_has_any(list_filter(a, lambda w: length(w) > 2), b)),
    l AS (SELECT c1, comision_id AS own, s AS got FROM (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY s DESC, comision_id) AS rn FROM p) WHERE rn = 1),
    m AS (SELECT p.c1, count(*) FILTER (s >= 0.9 * top) AS many FROM p JOIN (SELECT c1, max(s) AS top FROM p GROUP BY 1) t ON p.c1 = t.c1 GROUP BY 1),
    n AS (SELECT p.c1, count(*) FILTER (abs(s - got) < 0.05) AS near FROM p JOIN l ON p.c1 = l.c1 AND comision_id <> own GROUP BY 1),
    r AS (SELECT v.c1, got, unnest([CASE WHEN got < 0.7 THEN 'low_similarity' END, CASE WHEN near > 0 THEN 'near_tie' END, CASE WHEN many > 2 THEN 'ambiguous' END, CASE WHEN got IS NULL THEN 'unlinked' END]) AS reason FROM v LEFT JOIN l ON v.c1 = l.c1 LEFT JOIN m ON v.c1 = m.c1 LEFT JOIN n ON v.c1 = n.c1)
    SELECT c1, reason, got AS score FROM r WHERE reason IS NOT NULL""")
def linkage_review(spark: SparkSession, d: str) -> DataFrame:
    """What of the linkage of typed committees by common words should be looked at."""
    v = table(spark, d, "iniciativas_pa").select("c1").where("c1 IS NOT NULL").distinct().withColumn("a", words("c1"))
    c = table(spark, d, "cat_comisiones").select("comision_id", words("comision").alias("b"))
    word = lambda x: F.explode(F.filter(x, lambda w: F.length(w) > 2)).alias("word")
    p = v.select("c1", "a", word("a")).join(c.select("comision_id", "b", word("b")), "word").drop("word").distinct()
    p = p.select("c1", "comision_id", F.round(dice(F.col("a"), F.col("b")), 9).alias("score"))
    return review_list(p, joins.top_one(p, ["c1"], F.col("score"), ["comision_id"]).select("c1", "comision_id", "score"), v, "c1", "comision_id", "score", many=2)


# --- noise of title pages ---------------------------------------------------------------------------------------


def _without_sql(text: str, patterns: tuple[str, ...], by: str) -> str:
    for p in patterns:
        text = f"regexp_replace({text}, '{p.replace('(?iu)', '(?i)')}', '{by}', 'g')"
    return text


_COVERED = "'--- Page 12 ---\n  H. Congreso del Estado\nP U E B L A  Secretaría General\nESTADOS UNIDOS MEXICANOS\n\n\n\nAv. 32 Oriente No. 1, C.P. 72290 www.congresolocal.gob.mx\nMarzo. Mes de las Mujeres\nActa de Puebla: ' || descripcion || '\nPag. ' || registro_id || '\n'"


@query(f"""
    SELECT registro_id, trim(regexp_replace({_without_sql("replace(t, chr(10), ' ')", cleaning.cover_noise(), ' ')}, '\\s+', ' ', 'g')) AS flat,
        regexp_replace(regexp_replace({_without_sql('t', cleaning.cover_noise(lined=True), ' ')}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', E'\\n\\n', 'g') AS lined FROM (SELECT registro_id, {_COVERED} AS t FROM iniciativas_pa)""")
def without_covers(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions between title page and footer, the noise taken off on one line and with lines kept."""
    t = F.expr(_COVERED.replace("\n", "\\n"))
    r = table(spark, d, "iniciativas_pa").select("registro_id", t.alias("t"))
    flat = cleaning.flat_text(F.replace("t", F.lit("\n"), F.lit(" ")), cleaning.cover_noise())
    lined = cleaning.lined_text("t", cleaning.cover_noise(lined=True), " ")
    return r.select("registro_id", flat.alias("flat"), lined.alias("lined"))


@query("""
    WITH w AS (SELECT DISTINCT doc_id, unnest(list_transform(list_filter(regexp_extract_all(lower(strip_accents(text)), '[\\p{L}\\p{Nd}]+'), lambda x: length(x) > 1 OR regexp_matches(x, '^\\d$')), lambda x: left(x, 6))) AS stem FROM documents WHERE source = 'fe_de_erratas' OR source = 'nota_exterior'),
    n AS (SELECT count(*) AS docs FROM documents WHERE source = 'fe_de_erratas' OR source = 'nota_exterior'), i AS (SELECT stem, ln((any_value(docs) + 1) / (count(*) + 0.5)) AS idf FROM w, n GROUP BY 1), b AS (SELECT doc_id, stem, idf FROM w JOIN i USING (stem)),
    s AS (SELECT doc_id, sum(idf) AS whole FROM b GROUP BY 1), q AS (SELECT doc_id FROM s WHERE doc_id % 20 = 0),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.idf) AS common FROM b x JOIN b y ON x.stem = y.stem AND x.doc_id <> y.doc_id WHERE x.doc_id IN (SELECT doc_id FROM q) GROUP BY 1, 2)
    SELECT a AS doc_id, b AS other, round(2 * common / (s.whole + t.whole), 6) AS score FROM c JOIN s ON s.doc_id = a JOIN s t ON t.doc_id = b WHERE 2 * common / (s.whole + t.whole) >= 0.3""")
def weighted_dice(spark: SparkSession, d: str) -> DataFrame:
    """Short notices and notes alike by their stems, rare stems weighing more; every twentieth is looked up among all."""
    from curul.functions.similarity import stems
    from curul.operators.linkage import weighted_dice_links

    n = table(spark, d, "documents").where(F.col("source").isin("fe_de_erratas", "nota_exterior")).select("doc_id", stems(F.col("text"), stop=()).alias("stems"))
    links = weighted_dice_links(n.where(F.pmod("doc_id", F.lit(20)) == 0), n, "doc_id", "doc_id", "stems", 0.3).where("left <> right")
    return links.select(F.col("left").alias("doc_id"), F.col("right").alias("other"), F.round("score", 6).alias("score"))
