import datetime as dt
import json
import random
import zipfile

from pyspark.sql import functions as F

from curul.operators import aggregates, documents, incremental, joins, linkage, numbering, quality
from curul.operators.components import connected_components
from curul.operators.imputation import fill_missing, mine_dependencies
from curul.sources import envelopes, external, files, html
from curul.streaming import tables as streams


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_folios_like_a_sequential_counter(spark):
    rng = random.Random(1)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(1500)) for _ in range(60)] + [None]

    def count(ds):
        state, out = (None, None, None), []
        a = b = 0
        for d in ds:
            c = d.year - (0 if (d.month, d.day) >= (9, 15) else 1)
            t, y = c - (c - 2024) % 3, (c - 2024) % 3 + 1
            md = d.month * 100 + d.day
            p = 1 if md >= 915 or md <= 114 else 2 if md <= 514 else 3
            if state[0] != t:
                a = b = 0
            elif state != (t, y, p):
                b = 0
            state = (t, y, p)
            a, b = a + 1, b + 1
            out.append((a, b))
        return out

    df = spark.createDataFrame([(k, 0, d) for k, d in enumerate(days)], "k int, part int, d date")
    got = [(r.folio_term, r.folio_period) for r in numbering.folios(df, ["part"], ["k"], "d").orderBy("k").collect()]
    assert got[:-1] == count(days[:-1]) and got[-1] == (None, None)
    order = sorted(range(60), key=lambda k: (days[k], k))
    by_key = {r.k: (r.folio_term, r.folio_period) for r in numbering.folios_by_key(df, ["d", "k"], "d").collect()}
    assert [by_key[k] for k in order] == count([days[k] for k in order])


def test_fragments_and_slices(spark):
    f = spark.createDataFrame([(1, "a", False, "x"), (2, "a", True, "y"), (3, "a", False, "z"), (4, "b", False, "w")], "k int, t string, closed boolean, text string").withColumn("p", F.lit(1))
    assert [(r.t, r.text) for r in numbering.merge_fragments(f, ["p"], ["k"], ["t"], "closed", "text").orderBy("chain").collect()] == [("a", "x\ny"), ("a", "z"), ("b", "w")]
    s = spark.createDataFrame([(1, 1, "abcdef"), (1, 4, "abcdef")], "id int, at int, text string")
    assert [r.slice for r in numbering.slices(s, ["id"], "at", "text").orderBy("at").collect()] == ["abc", "def"]


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (10, 11), (5, 5), (None, 4), (20, 21), (21, 22), (22, 23), (23, 24), (24, 25), (25, 26)]
    got = dict(rows(connected_components(spark.createDataFrame(links, "a int, b int"), "a", "b")))
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, **{k: 20 for k in range(20, 27)}}
    assert connected_components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_asof_against_brute_force(spark):
    rng = random.Random(2)
    left = [(k, rng.randrange(3), rng.randrange(50)) for k in range(60)]
    right = sorted({(rng.randrange(3), rng.randrange(50)) for _ in range(30)})
    a, b = spark.createDataFrame(left, "k int, g int, at int"), spark.createDataFrame([(g, t, f"{g}-{t}") for g, t in right], "g int, t int, v string")
    back = {r.k: r.v for r in joins.asof(a, b, ["g"], "at", "t", ["v"], tolerance=F.lit(10)).collect()}
    ahead = {r.k: r.v for r in joins.asof(a, b, ["g"], "at", "t", ["v"], forward=True).collect()}
    for k, g, at in left:
        before = [t for h, t in right if h == g and at - 10 <= t <= at]
        after = [t for h, t in right if h == g and t >= at]
        assert back[k] == (f"{g}-{max(before)}" if before else None)
        assert ahead[k] == (f"{g}-{min(after)}" if after else None)


def test_band_and_range(spark):
    d0 = dt.date(2024, 1, 1)
    a = spark.createDataFrame([(1, d0 + dt.timedelta(days=k)) for k in range(0, 60, 7)], "g int, x date")
    b = spark.createDataFrame([(1, d0 + dt.timedelta(days=k)) for k in range(0, 60, 5)], "g int, y date")
    got = rows(joins.band_join(a, b, ["g"], "x", "y", 12).select("x", "y"))
    assert got == rows(a.join(b, "g").where("datediff(x, y) BETWEEN 0 AND 12").select("x", "y"))
    v = spark.createDataFrame([(1, k) for k in range(30)], "g int, v int")
    r = spark.createDataFrame([(1, 3, 8), (1, 8, 25), (1, 9, 2), (1, -3, 0)], "g int, lo int, hi int")
    assert rows(joins.range_join(v, r, ["g"], "v", "lo", "hi", 10).select("v", "lo")) == rows(v.join(r, "g").where("v BETWEEN lo AND hi").select("v", "lo"))


def test_greedy_against_plain_rule(spark):
    rng = random.Random(3)
    pairs = [("d1", i, j, round(rng.random(), 3)) for i in range(6) for j in range(6)] + [("d2", 0, 0, 0.3), ("d3", 0, 0, 0.1)]
    df = spark.createDataFrame([(d, i, j, s + 0.001 * i, s) for d, i, j, s in pairs], "d string, i int, j int, score double, s double")
    got = rows(joins.greedy_assignment(df, ["d"], "i", "j", "score", "s", 0.6, 0.25).select("d", "i", "j"))
    want, ui, uj = [], set(), set()
    for sc, s, i, j in sorted(((s + 0.001 * i, s, i, j) for d, i, j, s in pairs if d == "d1"), reverse=True):
        if s >= 0.6 and i not in ui and j not in uj:
            want.append(("d1", i, j))
            ui.add(i)
            uj.add(j)
    assert got == sorted([*want, ("d2", 0, 0)], key=repr)


def test_linkage_in_order(spark):
    p = [(1, 1, 10, 100, 0.9), (1, 1, 11, 100, 0.95), (1, 2, 12, 100, 1.0), (1, 2, 12, 101, 0.5), (1, 1, 10, 102, 0.4)]
    df = spark.createDataFrame(p, "g int, day int, e int, r int, s double")
    assert rows(linkage.link_in_order(df, ["g"], "day", "e", "r", "s").select("e", "r")) == [(10, 102), (11, 100), (12, 101)]


def test_candidate_links_are_all_pairs_not_later(spark):
    from curul.functions.similarity import dice, stems

    rng, vocabulary = random.Random(5), "punto acuerdo exhorta ley reforma agua becas caminos salud vivienda escuela museo pesca turismo".split()
    text = lambda: " ".join(rng.sample(vocabulary, rng.randint(1, 9)))
    v = [(k, f"20{rng.randint(10, 25)}-03-0{rng.randint(1, 3)}", text()) for k in range(40)] + [(90, "2025-01-01", "Acuerdo de becas rurales"), (91, "2025-01-01", None)]
    i = [(k, f"20{rng.randint(10, 25)}-03-0{rng.randint(1, 3)}", text()) for k in range(60)] + [(90, "2015-01-01", "Punto de acuerdo de becas rurales"), (91, "2025-01-02", "Acuerdo de becas rurales"), (92, "2025-01-01", "")]
    e = spark.createDataFrame(v, "e int, day string, t string").withColumn("day", F.to_date("day"))
    r = spark.createDataFrame(i, "r int, d string, u string").withColumn("d", F.to_date("d"))
    want = e.crossJoin(r).where("d <= day").withColumn("similarity", dice(stems(F.col("t")), stems(F.col("u")))).where("similarity >= 0.3")
    for block in (4096, 16):
        got = linkage.candidate_links(e, "e", "day", "t", r, "r", "d", "u", 0.3, block)
        assert rows(got) == rows(want.select("e", "day", "r", "similarity"))
    pairs = {(x[0], x[2]) for x in rows(got)}
    assert (90, 90) in pairs and (90, 91) not in pairs


def test_linked_records_are_gone_in_later_terms(spark):
    df = spark.createDataFrame([("2020-01-01", 1, 100, 0.9), ("2024-01-01", 2, 100, 1.0), ("2024-01-01", 2, 101, 0.5)], "day string, e int, r int, s double")
    assert rows(linkage.link_in_order(df, [], "day", "e", "r", "s").select("e", "r")) == [(1, 100), (2, 101)]


def test_reconcile_and_lookups(spark):
    a, b = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, x int"), spark.createDataFrame([(1, 5), (2, None), (3, 8), (4, 1)], "k int, y int")
    assert {r.k: r.outcome for r in joins.reconcile(a, b, ["k"], "x", "y").collect()} == {1: "equal", 2: "equal", 3: "different", 4: "only_right"}
    last = joins.last_wins(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, v string"), ["k"], "n")
    assert rows(last) == [("a", 2, "y")]
    f = joins.fuzzy_lookup(spark.createDataFrame([("Ana Lopez Ruiz",), ("ANA LÓPEZ RUIZ",), ("Ana Lopes Ruiz",), ("Zzz",), (None,)], "n string"), spark.createDataFrame([("Ana López Ruiz",)], "m string"), "n", "m")
    assert {r.left: r.right for r in f.collect()} == {"Ana Lopez Ruiz": "Ana López Ruiz", "ANA LÓPEZ RUIZ": "Ana López Ruiz", "Ana Lopes Ruiz": "Ana López Ruiz", "Zzz": None}
    t = spark.createDataFrame([(1, "la comisión de Salud Pública y la de salud"), (2, None), (3, "")], "id int, t string")
    assert {r.id: r.phrases for r in joins.phrases_in(t, "id", "t", ["Salud", "Salud Pública", ""]).collect()} == {1: ["salud publica", "salud"], 2: [], 3: []}


def test_fill_missing(spark):
    data = [(1, "ana", "A", "c1", "P", 9), (2, "ana", "A", "c1", None, 9), (3, "ana", "B", "c2", None, 9), (4, "eva", "A", "c2", "Q", 9), (5, "eva", "A", "c2", "R", 9), (6, "eva", "A", "c1", None, 9), (7, None, None, None, None, 9)]
    df = spark.createDataFrame(data, "id int, who string, leg string, com string, value string, n int")
    r = {x.id: (x.value_filled, x.value_source) for x in fill_missing(df, "value", [["who", "leg"]], group=["com"]).collect()}
    assert r == {1: ("P", "observed"), 2: ("P", "dependency:who+leg"), 3: (None, None), 4: ("Q", "observed"), 5: ("R", "observed"), 6: ("P", "group:com"), 7: (None, None)}
    assert fill_missing(df.limit(0), "value", [["who", "leg"]], group=["com"]).count() == 0
    m = {x.determinant: (x.records, x.agreeing, x.verified) for x in mine_dependencies(df, [["who"], ["n"]], "value", 0.6).collect()}
    assert m == {"who": (2, 1, False), "n": (3, 1, False)}
    hot = spark.range(30_000).select("id", F.lit("ana").alias("who"), F.when(F.col("id") % 3 > 0, "P").alias("value"))
    assert fill_missing(hot, "value", [["who"]]).groupBy("value_source").count().count() == 2


def test_aggregates(spark):
    d = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("b", None, 4)], "k string, v string, n int")
    assert rows(aggregates.most_frequent(d, ["k"], "v")) == [("a", "y", 2)]
    assert rows(aggregates.keep_first(d, ["k"], ["n"])) == [("a", "x", 1), ("b", None, 4)]
    p = aggregates.pivot_values(d, ["k"], "v", "n", ["x", "z"])
    assert rows(p) == [("a", "1", "-"), ("b", "-", "-")]
    assert rows(quality.violations(d, ["n"], {"odd": F.col("n") % 2 == 1, "null": F.col("v").isNull(), "unknown": F.lit(None).cast("boolean")})) == [(1, "odd"), (3, "odd"), (4, "null")]


def test_incremental(spark):
    s = spark.createDataFrame([("a", True, 1), ("b", False, 2), ("c", True, 2)], "k string, finished boolean, version int")
    src = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "k string")
    assert rows(incremental.pending(src, s, "k")) == rows(spark.createDataFrame([("b",), ("d",), (None,)], "k string"))
    assert incremental.pending(src, s, "k", version=2, again=True).count() == 4 and incremental.pending(src, s, "k", force=True).count() == 5
    old, new = spark.createDataFrame([("a", "ok", 1), ("b", "error", 1)], "k string, st string, at int"), spark.createDataFrame([("a", "error", 2), ("b", "ok", 2), ("c", "error", 2)], "k string, st string, at int")
    assert rows(incremental.upsert_by_status(old, new, "k", "st", ["at"])) == [("a", "ok", 1), ("b", "ok", 2), ("c", "error", 2)]


def test_documents(spark):
    d = spark.createDataFrame([(1, "uno\nPag. 5\ndos\nPag. 6\ntres"), (2, "sin pie"), (3, None), (4, "")], "id int, t string")
    assert [tuple(r) for r in documents.pages(d, "id", "t").orderBy("id", "position").collect()] == [(1, 0, 5, "uno"), (1, 1, 6, "dos"), (1, 2, -1, "tres"), (2, 0, -1, "sin pie"), (4, 0, -1, "")]
    t = spark.createDataFrame([(1, "ORDEN DEL DÍA que celebra x ORDEN DEL DÍA nada ORDEN DEL DÍA que celebra y")], "id int, t string")
    assert [r.text for r in documents.segments(t, "id", "t", "ORDEN DEL DÍA", ("que celebra", 30)).orderBy("position").collect()][0].startswith("ORDEN DEL DÍA que celebra x")
    n = spark.createDataFrame([(1, "1. Lista 2. Lectura del Punto de Acuerdo x 4. Otro 3. Fin")], "id int, t string")
    items = documents.numbered_items(n, "id", "t")
    assert [(r.number, r.text) for r in items.orderBy("number").collect()] == [(1, "Lista"), (2, "Lectura del Punto de Acuerdo x 4. Otro"), (3, "Fin")]
    assert [r.k for r in items.orderBy("number").select(documents.item_kind(F.col("text")).alias("k")).collect()] == [None, "Punto de Acuerdo", None]
    v = spark.createDataFrame([("con treinta y nueve votos a favor, dos en contra y una abstención",), ("nada en contrario",)], "t string").select(documents.vote_counts(F.col("t")).alias("v"))
    assert [tuple(r.v) for r in v.collect()] == [(39, 2, 1), (None, None, None)]
    text = "LISTA DE ASISTENCIA de la sesión Ordinaria del O2 de septiembre de 2025\n1. Ana Ruiz Paz -Asistencia\n2 Eva Sol Mar\nnota 3\n3. Orden del día"
    a = documents.attendance_table(spark.createDataFrame([(1, text), (2, None)], "id int, t string"), "id", "t", ("Asistencia", "Con licencia"))
    assert [(r.number, r.name, r.label, r.day) for r in a.orderBy("number").collect()][:2] == [(1, "Ana Ruiz Paz", "Asistencia", "2 de septiembre de 2025"), (2, "Eva Sol Mar", "No aplica", "2 de septiembre de 2025")]
    x = spark.createDataFrame([("Lectura de la iniciativa por el que se reforma  la ley; ",)], "t string").select(documents.description(F.col("t")).alias("x")).first().x
    assert x == "por el que se reforma la ley."


def test_sources(spark, tmp_path):
    shapes = {"a": '{"registros": [{"n": 1}, 5]}', "b": '﻿[{"n": 2}]', "c": '{"lista": [{"n": 3}]}', "d": '{"k1": {"n": 4}, "k2": {"n": 5, "x": 1}}', "e": "{no json"}
    for k, v in shapes.items():
        (tmp_path / f"{k}.json").write_text(v, encoding="utf-8")
    assert sorted(r.n for r in envelopes.read_envelopes(spark, str(tmp_path), "n int").collect()) == [1, 2, 3, 4, 5]
    assert envelopes.broken_envelopes(spark, str(tmp_path)).count() == 1
    page = "<ul><li class=a><a href='/x'>Uno<br>dos</a><li>t</ul>"
    assert [(e["href"], e["text"]) for e in html.elements(page, {"a"})] == [("/x", "Unodos")] and html.elements(None, {"a"}) == []
    assert spark.createDataFrame([(page,)], "p string").select(F.size(html.html_elements(F.col("p"), ["li"])).alias("n")).first().n == 2
    assert files.read_settings("﻿A=1\n#x=2\nB = 'y'".encode()) == {"A": "1", "B": "y"} and files.read_settings("A=1".encode("utf-16")) == {"A": "1"}
    files.write_workbook(str(tmp_path / "o.xlsx"), {"Hoja/1": spark.createDataFrame([(1, "a<b"), (2, None)], "n int, t string")})
    with zipfile.ZipFile(tmp_path / "o.xlsx") as z:
        assert b"a&lt;b" in z.read("xl/worksheets/sheet1.xml")
    files.write_records(spark.createDataFrame([(1, "x")], "n int, t string"), str(tmp_path / "out"), ["t"])
    assert json.loads(next((tmp_path / "out" / "t=x").glob("*.json")).read_text()) == {"n": 1}


def test_service_calls(spark):
    def service(batch):
        if any("bad" in b for b in batch):
            raise RuntimeError("503 overloaded")
        return [b.upper() for b in batch]

    data = [(1, "a"), (2, None), (3, "bad"), (4, "bad"), (5, "c")]
    r = external.with_error_kind(external.call_service(spark.createDataFrame(data, "k int, p string").coalesce(1), "k", "p", service, batch=1, attempts=2, wait=0.0, breaker=2))
    assert {x.k: (x.result, x.error) for x in r.collect()} == {1: ("A", None), 2: (None, "empty"), 3: (None, "503 overloaded"), 4: (None, "503 overloaded"), 5: (None, "not attempted")}


def test_streams(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    src = spark.createDataFrame([(t0 + dt.timedelta(minutes=7 * k), "a" if k % 2 else "b", 1.0) for k in range(20)], "ts timestamp, k string, v double")
    src.write.parquet(str(tmp_path / "in"))
    s = streams.window_counts(streams.read_growing(spark, str(tmp_path / "in"), src.schema), "ts", ["k"], "v", "30 minutes", "1 day")
    streams.run_to_table(s, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0] == 20
    ses = streams.session_counts(streams.read_growing(spark, str(tmp_path / "in"), src.schema), "ts", ["k"], "20 minutes", "1 day")
    streams.run_to_table(ses, str(tmp_path / "out2"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "out2")).count() == 2
    up = spark.createDataFrame([("a", "ok", 1), ("a", "error", 2)], "k string, st string, at int")
    up.write.parquet(str(tmp_path / "up"))
    streams.stream_upsert(streams.read_growing(spark, str(tmp_path / "up"), up.schema), str(tmp_path / "state"), str(tmp_path / "cp3"), "k", "st", ["at"])
    assert rows(spark.read.parquet(str(tmp_path / "state" / "v0"))) == [("a", "ok", 1)]


def test_locate_in_order(spark):
    recs = spark.createDataFrame([("s1", 1, "Ley de aguas"), ("s1", 2, "Reforma fiscal"), ("s2", 1, "Vivienda digna"), ("s2", 2, "Salud pública"), ("s2", 3, "No hay"), ("s3", 1, None)], "g string, k bigint, title string")
    docs = spark.createDataFrame([("s1", 7, "x"), ("s1", 9, "y"), ("s2", 4, "INICIATIVA DE SALUD PUBLICA"), ("s2", 5, "dictamen de vivienda digna y otros")], "g string, k bigint, text string")
    assert rows(documents.locate_in_order(recs, docs, "g", "k", "title", "text")) == [("s1", 1, 7), ("s1", 2, 9), ("s2", 1, 5), ("s2", 2, 4), ("s2", 3, None), ("s3", 1, None)]


def test_locate_titles_after_a_long_letterhead(spark):
    head = "C. Diputados integrantes de la Mesa Directiva, calle y número. " * 30
    recs = spark.createDataFrame([("s", 1, "Salud pública"), ("s", 2, "Vivienda digna"), ("s", 3, "No hay")], "g string, k bigint, title string")
    docs = spark.createDataFrame([("s", 4, head + "INICIATIVA DE SALUD PUBLICA" + head), ("s", 5, head + "Dictamen de viviendas digna" + head)], "g string, k bigint, text string")
    assert rows(documents.locate_in_order(recs, docs, "g", "k", "title", "text")) == [("s", 1, 4), ("s", 2, 5), ("s", 3, None)]


def test_record_fields(spark):
    from curul.functions import records

    t = ["Licenciatura en Derecho por la Universidad Serrana", "Maestría en Letras, Instituto del Valle", "lic.", "Preparatoria", None]
    got = [tuple(r.s) for r in spark.createDataFrame([(x,) for x in t], "t string").select(records.study("t").alias("s")).collect()]
    assert got == [("Licenciatura", 2.0, "Derecho", "Universidad Serrana"), ("Maestría", 5.0, "Letras", "Instituto del Valle"), ("Licenciatura", 2.0, None, None), ("Bachillerato", 1.0, None, None), (None, None, None, None)]
    p = ["+52 1 195 033 90 76", "01 (165) 949 07 52 ext. 3", "1515982299", "523-23-24", None]
    assert [r.x for r in spark.createDataFrame([(x,) for x in p], "t string").select(records.phone_form("t").alias("x")).collect()] == ["195 033 9076", "165 949 0752", "151 598 2299", None, None]
    n = ["Ana Ñuñez Paz", "Paz Zúñiga, Luis", "Dip. Eva de la Cruz Sol"]
    assert [r.x for r in spark.createDataFrame([(x,) for x in n], "t string").select(records.surname_key("t").alias("x")).collect()] == ["n\uffffun\uffffez paz|ana", "paz zun\uffffiga|luis", "de la cruz sol|eva"]
    r = spark.createDataFrame([(["Ana Paz", "ANA PAZ", "Eva"], "A. Uno Dos, Tres Cuatro y Cinco", 3)], "a array<string>, t string, n int")
    x = r.select(records.distinct_folded(F.col("a")).alias("d"), records.people("t").alias("p")).first()
    assert x.d == ["Ana Paz", "Eva"] and x.p == ["A. Uno Dos", "Tres Cuatro"]
    assert records.with_defaults(r, {"n": F.lit(0), "z": F.lit("-")}).first().z == "-" and records.column_kind("Fecha de acta") == "date"


def test_weighted_links_against_brute_force(spark):
    import math
    import random
    from collections import Counter

    from curul.operators.linkage import weighted_dice_links

    rng = random.Random(4)
    word = lambda: f"w{int(rng.expovariate(0.05))}"
    rows = [(k, sorted({word() for _ in range(rng.randrange(0, 14))})) for k in range(120)]
    df = spark.createDataFrame(rows, "id int, stems array<string>")
    got = {(r.left, r.right): r.score for r in weighted_dice_links(df.where("id < 30"), df, "id", "id", "stems", 0.3).collect()}
    n, f = len(rows), Counter(w for _, s in rows for w in s)
    idf = {w: math.log((n + 1) / (c + 0.5)) for w, c in f.items()}
    want = {}
    for a, x in rows[:30]:
        for b, y in rows:
            whole = sum(idf[w] for w in x) + sum(idf[w] for w in y)
            s = 2 * sum(idf[w] for w in set(x) & set(y)) / whole if whole else 0
            if s >= 0.3:
                want[a, b] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_fill_with_hot_null_and_tied_keys(spark):
    from curul.operators.imputation import fill_missing, find_dependencies

    rows = [(k, "hot" if k % 3 == 0 else f"p{k % 40}" if k % 7 else None, "a" if k % 2 else "b", (1 if k % 3 == 0 else k % 40) if k % 5 else None) for k in range(1200)]
    df = spark.createDataFrame(rows, "id int, person string, term string, party int")
    assert ["person"] in find_dependencies(df, ["person", "term"], "party")
    out = {r.id: (r.party_filled, r.party_source) for r in fill_missing(df, "party", [["person"]]).collect()}
    assert len(out) == 1200
    for k, person, _, party in rows:
        want = (party, "observed") if party is not None else (None, None) if person is None else (1 if person == "hot" else None, "dependency:person")
        assert out[k][1] == want[1] or person is not None
        if person == "hot":
            assert out[k][0] == 1
    assert fill_missing(df.limit(0), "party", [["person"]]).count() == 0
    assert find_dependencies(df.limit(0), ["person"], "party") == []


def test_stream_state_that_cannot_be_read_raises(spark, tmp_path):
    import pytest

    from curul.streaming.tables import read_growing, stream_upsert

    src, state, mark = (str(tmp_path / x) for x in ("src", "state", "mark"))
    rows = spark.createDataFrame([("k1", "ok", 1), ("k2", "failed", 1)], "key string, status string, at int")
    rows.coalesce(1).write.parquet(src)
    stream_upsert(read_growing(spark, src, rows.schema), state, mark, "key", "status", ["at"])
    before = spark.read.parquet(f"{state}/v0").count()
    for f in (tmp_path / "state" / "v0").glob("*.parquet"):
        f.write_bytes(b"broken")
    rows.coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        stream_upsert(read_growing(spark, src, rows.schema), state, mark, "key", "status", ["at"])
    assert before == 2


def test_matching_is_the_walk_through_all_pairs(spark):
    import random

    from curul.operators.matching import greedy_matching

    rng = random.Random(2)
    pairs = sorted({(rng.randrange(25), rng.randrange(25), rng.randrange(6)) for _ in range(150)})
    df = spark.createDataFrame([*pairs, pairs[0]], "a int, b int, s int")
    got = {(r.a, r.b) for r in greedy_matching(df, ["a"], ["b"], F.struct((-F.col("s")).alias("s"), "a", "b")).collect()}
    used_a, used_b, want = set(), set(), set()
    for a, b, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in used_a and b not in used_b:
            used_a.add(a), used_b.add(b), want.add((a, b))
    assert got == want and greedy_matching(df.limit(0), ["a"], ["b"], F.struct("s", "a", "b")).count() == 0
