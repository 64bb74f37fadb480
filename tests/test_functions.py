import datetime as dt

import pytest
from pyspark.sql import functions as F

from curul.functions import calendar as cal
from curul.functions import classify, cleaning
from curul.functions.lexicon import Catalog, Trie, levenshtein
from curul.functions.names import is_body, person_cost, person_words, same_body
from curul.functions.numbers_es import WORDS, number_of, words_of
from curul.functions.similarity import partial_ratio, sequence_ratio, title_similarity, token_set_ratio
from curul.functions.unicode_text import canonical, fold, is_missing


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("x")).first()["x"] if values else spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("day", "year", "period", "kind"),
    [("2024-09-14", 3, 3, "receso"), ("2024-09-15", 1, 1, "periodo"), ("2024-12-15", 1, 1, "periodo"), ("2024-12-16", 1, 1, "receso"), ("2025-01-14", 1, 1, "receso"), ("2025-01-15", 1, 2, "periodo"),
     ("2025-03-15", 1, 2, "periodo"), ("2025-03-16", 1, 2, "receso"), ("2025-05-14", 1, 2, "receso"), ("2025-05-15", 1, 3, "periodo"), ("2027-09-15", 1, 1, "periodo"), ("2021-09-15", 1, 1, "periodo"), ("2000-01-01", 3, 1, "receso")],
)
def test_calendar(spark, day, year, period, kind):
    r = spark.createDataFrame([(dt.date.fromisoformat(day),)], ["d"]).select(cal.legislative_year("d").alias("y"), cal.period("d").alias("p"), cal.period_or_recess("d").alias("k")).first()
    assert (r.y, r.p, r.k.kind, r.k.number) == (year, period, kind, period)


def test_dates_read_in_every_form_and_invalid_is_null(spark):
    texts = ["2024-05-14", "14/05/2024", "14/5/24", "14 de mayo de 2024", "14 de MAYO 2024", "el 14 de mayo del 2024, martes", "45426", "31/02/2024", "1/1/70", "", None, "sin fecha"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(cal.any_date("t").alias("x")).collect()]
    d = dt.date(2024, 5, 14)
    assert got == [d, d, d, d, d, d, d, None, dt.date(1970, 1, 1), None, None, None]


def test_times(spark):
    texts = ["09:25:03", "02:15:00 p.m.", "12:00 a.m.", "12:00 p.m.", "9:05", "24:00", "10:60", None, "x"]
    got = [r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select(cal.seconds_of_day("t").alias("x")).collect()]
    assert got == [33903, 51300, 0, 43200, 32700, None, None, None, None]
    r = spark.createDataFrame([(36000, 35910, 600)], ["called", "begun", "ended"]).select(cal.delay_minutes("called", "begun").alias("m"), cal.duration_seconds("begun", "ended").alias("d"), cal.clock("called", 12).alias("c")).first()
    assert (r.m, r.d, r.c) == (-2, 51090, "10:00:00 a.m.")


def test_number_words_round_trip(spark):
    r = spark.range(100).select("id", number_of(words_of(F.col("id"))).alias("n")).collect()
    assert all(x.id == x.n for x in r) and len(set(WORDS)) == 100
    texts = ["Ciento veinte", "UN", "treinta y una", "12", "doscientos", "nada", None]
    assert [x.n for x in spark.createDataFrame([(t,) for t in texts], "t string").select(number_of(F.col("t")).alias("n")).collect()] == [120, 1, 31, 12, 200, None, None]


def test_classifiers(spark):
    t = spark.createDataFrame([("Iniciativa con proyecto de DECRETO",), ("Se EXHORTA al instituto",), ("Otro",), (None,)], "t string")
    assert [r.x for r in t.select(classify.keyword_class("t").alias("x")).collect()] == [1, 2, 0, None]
    e = spark.createDataFrame([("x Último error: 429 quota per day",), ("429",), ("503 overloaded",), ("Connection timeout",), ("Expecting value",), ("?",)], "t string")
    assert [r.x for r in e.select(classify.error_kind("t").alias("x")).collect()] == ["cuota_diaria_agotada", "cuota_agotada", "alta_demanda", "error_red", "respuesta_invalida", "error_desconocido"]
    v = spark.createDataFrame([("A favor", "Asistencia"), ("Abstención", "asistencia"), ("A favor", "Falta"), ("?", "Asistencia"), (None, None)], "v string, a string")
    assert [r.x for r in v.select(classify.vote_kind("v", "a").alias("x")).collect()] == ["favor", "abstencion", "ausente", "no_reconocido", "ausente"]


def test_cleaning(spark):
    r = spark.createDataFrame([("a\nPag. 3\nb  c", ["x", "y", "z"]), (None, [])], "t string, a array<string>").select(cleaning.flat_text("t").alias("f"), cleaning.join_with_y(F.col("a")).alias("j"), cleaning.safe_name(F.col("t")).alias("s")).collect()
    assert [(x.f, x.j) for x in r] == [("a b c", "x, y y z"), (None, "")] and r[1].s == "Sin tipo"
    d = spark.createDataFrame([(1, 2)], ["_oculto", "Fecha de Sesión"])
    assert cleaning.without_private(cleaning.rename_by_key(d, {"fecha de sesion": "fecha"})).columns == ["fecha"]


def test_similarities(spark):
    d = spark.createDataFrame([("ley de aguas", "ley de aguas"), ("ley de agua", "aguas de la ley"), ("", "x"), (None, "x")], "a string, b string")
    r = d.select(sequence_ratio("a", "b").alias("s"), token_set_ratio("a", "b").alias("t"), partial_ratio("a", "b").alias("p"), title_similarity(F.col("a"), F.col("b")).alias("m")).collect()
    assert (r[0].s, r[0].t, r[0].p, r[0].m) == (1.0, 100.0, 100.0, 1.0)
    assert (r[2].s, r[2].t, r[2].p, r[2].m) == (0.0, 0.0, 0.0, 0.0) and r[3].m == 0.0 and 0 < r[1].s < 1


def test_trie_against_plain_distance():
    stock = ["hacienda", "haciendas", "hospital", "salud", "salida", "agua"]
    t = Trie()
    for i, w in enumerate(stock):
        t.add(w, i)

    def osa(a, b):
        m = [[max(i, j) if not (i and j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                m[i][j] = min(m[i - 1][j] + 1, m[i][j - 1] + 1, m[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    m[i][j] = min(m[i][j], m[i - 2][j - 2] + 1)
        return m[-1][-1]

    for q in ["hacineda", "hacienda", "saldu", "salda", "aga", "hopsital", "zzz", "halcienda", "sa"]:
        for k in (0, 1, 2):
            assert {e for _, e, _ in t.search(q, k)} == {i for i, w in enumerate(stock) if osa(q, w) <= k}, (q, k)


def test_catalog():
    c = Catalog([(1, "Hacienda Pública y Cuenta Municipal"), (2, "Desarrollo Rural Integral"), (3, "Desarrollo Urbano y Ordenamiento")])
    for text, want in [("HACIENDA PUBLICA", 1), ("Cuenta Municipal y Hacienda Pública", 1), ("Comisión de Hda. Púb. y Cuenta Mpal.", 1), ("Desarrollo Rral Integral", 2), ("Com. de Desarrollo Urbano &", 3), ("Astronomía", -1), ("n/d", None), ("", None), (None, None)]:
        assert c.best(text)[0] == want, text
    n = Catalog([(7, "Salud Pública")], numbered=True)
    assert [n.best(x)[0] for x in ("7", " 07.- ", "(7)", "7.0", "7. Salud Pub.", "8", "tema 7")] == [7, 7, 7, 7, 7, -1, 7]
    with pytest.raises(ValueError):
        Catalog([(i, str(i)) for i in range(5)], limit=4)


def test_canonical():
    assert canonical("Ｓuѕana​  Ñuño") == ("Susana  Ñuño", True)
    assert canonical("José") == ("José", True)
    for same in ("Дружба", "Δημοκρατία", "5º ½ m² «a» “b” …", "María  ñ", "", None):
        assert canonical(same) == (same, False)
    assert canonical("a b у c")[0] == "a b y c" and fold("Ｎúñez") == "nunez"
    assert canonical("x" * 300_000 + "​")[0] == "x" * 300_000
    assert [is_missing(x) for x in (None, " ", "--", "N/A", "Sin información", "nan", "Sin Partido", "s/d")] == [True] * 6 + [False, True]


def test_names():
    official = person_words("Julio Fernando Ortitopón Bennocul")
    for typed in ("Dip. Julio F. Ortitopón Bennocul", "Ortitopón Bennocul, Julio Fernando", "Julio Fdo. Ortitopon B.", "JULIO ORTITOPÓN", "Jluio Ortitpón Bennocul"):
        assert person_cost(person_words(typed), official) < 5, typed
    for other in ("Julio Bennocul", "Fernando Ortitopón", "Julio Pecameda", "Octavio Ortitopón Bennocul"):
        assert person_cost(person_words(other), official) >= 5, other
    assert is_body("Ayto. de Queltzaro") and is_body("JCAP") and not is_body("Irma Quequecul Yocul")
    assert same_body(["junta", "conduccion", "acuerdos"], ["junta", "acuerdos", "politicos", "conduccion"]) and not same_body(["ayuntamiento", "tolmacan"], ["ayuntamiento", "queltzaro"])
    assert levenshtein("abc", "acb") == 2 and levenshtein("abc", "xyz", 1) == 2


def test_set_similarities_of_titles_with_odd_characters(spark, tmp_path):
    import re
    import unicodedata as ud

    from curul.functions.unicode_text import fold
    from curul.queries import set_similarities_all

    odd = ["Vivi\u200benda digna y obras", "\uff36\uff49\uff56\uff49\uff45\uff4e\uff44\uff41 digna", "Viviend\u0430 dign\u0430", "Educacio\u0301n ba\u0301sica", "Vivienda\u00a0digna", "Educación básica", "", "12 ½ ²"]
    data = [(k * 10 + n, t, o) for k, t in enumerate(odd) for n, o in enumerate(["Vivienda digna", "Educación básica y superior", "de la"])] + [(900, None, "x"), (901, "x", None)]
    spark.createDataFrame(data, "registro_id bigint, titulo string, tema string").write.parquet(str(tmp_path / "actas_extraidas_ia.parquet"))
    split = lambda t: {w for w in re.findall(r"\w+", "".join(c if ud.category(c)[0] == "L" or ud.category(c) == "Nd" else " " for c in fold(t))) if len(w) > 2}
    want = {}
    for i, t, o in data[:-2]:
        a, b = split(t), split(o)
        want[i] = (len(a & b) / len(a | b) if a | b else 0.0, len(a & b) / min(len(a), len(b)) if a and b else 0.0)
    assert {r.registro_id: (r.jaccard, r.containment) for r in set_similarities_all(spark, str(tmp_path)).collect()} == want
    assert all(want[k][1] == 1.0 for k in (0, 10, 20, 31, 40, 51))


def test_topic_by_committee_of_all_records(spark, tmp_path):
    from curul.queries import COMMITTEE_TOPICS, topic_by_committee_all

    c = [("COMISIÓN DE Vivienda digna", None), ("Comision Impartición de Justicia", None), ("Comité de la Vivienda Digna", "Pesca y Acuacultura"), ("Ninguna", "Comisión de Pesca y Acuacultura"), ("Agenda 2030 y convenios", None), (None, None), ("Turismo y Hospitalidad", None)]
    data = [(k, "Reforma el Código Penal" if k == 6 else "x", a, b, None, None, None, "Vivienda Digna" if k == 5 else None) for k, (a, b) in enumerate(c)]
    spark.createDataFrame(data, "registro_id bigint, descripcion string, c1 string, c2 string, c3 string, c4 string, c5 string, c6 string").write.parquet(str(tmp_path / "iniciativas_pa.parquet"))
    assert [r.topic for r in topic_by_committee_all(spark, str(tmp_path)).orderBy("registro_id").collect()] == [11, 14, 11, 12, 5, 11, 14]
    assert len(COMMITTEE_TOPICS) == 44


def test_short_forms_with_many_readings():
    letters = "abcdefghijklmnop"
    names = [f"Obras m{x * 6}a y s{x * 6}r t{x * 6}s" for x in letters]
    c = Catalog(list(enumerate(names)))
    assert {i for _, i, _ in c.near("Obras m. y sppppppr tpppppps")} == {15}
    assert {i for _, i, _ in c.near("Obras m. s. t.")} == set(range(16))
    assert c.near("Zzzzz m. s. t.") == []


def test_dates_and_numbers_in_words(spark):
    from curul.functions.calendar import called_or_estimated, clock, date_of_words, span, words_date
    from curul.functions.numbers_es import number_of, words_of

    texts = ["CELEBRADA EL LUNES CATORCE DE MAYO DE DOS MIL VEINTICUATRO A LAS", "el treinta y uno de diciembre de mil novecientos noventa y nueve", "el treinta y uno de febrero de dos mil diez", "el diez de mayo de dos mil, a las diez", "", None, "el 14 de mayo"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    assert [str(r.d) if r.d else None for r in df.orderBy("k").select(date_of_words("t").alias("d")).collect()] == ["2024-05-14", "1999-12-31", None, None, None, None, None]
    n = spark.range(1001).select("id", number_of(words_of(F.col("id"))).alias("n"))
    assert n.where("n <> id OR n IS NULL").collect() == [(1000, None)]
    assert [r.n for r in spark.createDataFrame([("Doscientas",), ("un",), ("ciento una",), ("12",), ("nada",), (None,)], "t string").select(number_of(F.col("t")).alias("n")).collect()] == [None, 1, 101, 12, None, None]
    t = spark.createDataFrame([(None, None), (None, 36125), (36000, 90)], "c int, b int")
    got = t.select(called_or_estimated("c", "b").alias("e"), clock("b").alias("x"), span(F.col("b") - F.col("c"), signed=True).alias("y")).collect()
    assert [(r.e.called, r.e.estimated, r.x, r.y) for r in got] == [(None, False, None, None), (36000, True, "10:02:05", None), (36000, False, "00:01:30", "-9:58:30")]
    assert spark.createDataFrame([(None,)], "d date").select(words_date("d")).first()[0] is None


def test_presented_items():
    from curul.operators.documents import presented_items

    t = "PUNTO TRES DEL ORDEN DEL DÍA. LA INICIATIVA DE DECRETO QUE PRESENTA LA DIPUTADA ANA RUIZ, POR EL QUE SE REFORMA LA LEY; TURNÁNDOSE A LA COMISIÓN DE SALUD, PARA SU ESTUDIO. ÚLTIMO PUNTO DEL ORDEN DEL DÍA, ASUNTOS GENERALES. EN USO DE LA PALABRA EL DIPUTADO JUAN PAZ, DIO CUENTA DEL PUNTO DE ACUERDO POR EL QUE SE PIDE AGUA."
    assert [x[1:] for x in presented_items(t)] == [("item", "INICIATIVA DE DECRETO", "LA DIPUTADA ANA RUIZ", "SE REFORMA LA LEY", "TRES", "COMISION DE SALUD"), ("floor", "PUNTO DE ACUERDO", "JUAN PAZ", "SE PIDE AGUA", "AG", None)]
    assert presented_items("") == [] and presented_items("QUE PRESENTA " * 2000) == []


def test_error_over_lines(spark):
    from curul.functions.classify import error_kind

    df = spark.createDataFrame([("429 RESOURCE_EXHAUSTED\n limit RequestsPerDay",), (None,)], "t string")
    assert [r.k for r in df.select(error_kind("t").alias("k")).collect()][0] == "cuota_diaria_agotada"
