import random

from pyspark.sql import functions as F

from curul.functions.lexicon import Catalog, levenshtein
from curul.llm.canonical_values import map_fields, match_values, read_catalog
from curul.llm.name_variants import body_entities, person_entities, radius_join, spelling_pairs, spellings_of, variant_entities
from curul.llm.visual_text import canonical_text


def test_radius_join_against_brute_force(spark):
    rng = random.Random(7)
    stock = sorted({"".join(rng.choice("abcdeou") for _ in range(rng.randrange(1, 13))) for _ in range(150)})
    typed = sorted({w[: rng.randrange(1, len(w) + 1)] + rng.choice("abz") + w[rng.randrange(len(w)) :] for w in stock for _ in range(2)} | set(stock[:40]))
    near = radius_join(spark.createDataFrame([(w,) for w in [*typed, None]], "word string"), spark.createDataFrame([(w,) for w in [*stock, None]], "word string"), pivots=12)
    radius = lambda n: 0 if n < 3 else 1 if n < 4 else 2 if n < 9 else 3
    want = {(a, b, levenshtein(a, b)) for a in typed for b in stock if levenshtein(a, b) <= radius(len(a))}
    got = [tuple(r) for r in near.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    empty = spark.createDataFrame([], "word string")
    assert radius_join(empty, empty).count() == 0


def test_persons(spark):
    roster = spark.createDataFrame([("Julio Fernando Ortitopón Bennocul",), ("Octavio Becul Ingeparro",), ("Octavio Brucul Ingeparra",), (None,), ("Solo",)], "nombre string")
    typed = {"Dip. Julio Fdo. Ortitopón B.": 0, "ortitopon bennocul, julio": 0, "Octavio Brcul Ingeparro": 1, "Octavio Bruculo Ingeparra": 2, "Otra Persona Cualquiera": 3}
    from curul.operators.name_resolution import parse_spellings

    p = parse_spellings(spark.createDataFrame([(t,) for t in [*typed, "", "N/A"]], "spelling string"), "spelling")
    got = {r.spelling: r.person for r in person_entities(p.where("kind = 'person'").select("spelling", "words"), roster, "nombre").collect()}
    names = ["julio fernando ortitopon bennocul", "octavio becul ingeparro", "octavio brucul ingeparra", "~cualquiera otra persona"]
    assert got == {t: names[k] for t, k in typed.items()}


def test_bodies_and_pairs(spark):
    data = ["Junta de Conducción y Acuerdos Políticos", "JCAP", "Jta. de Acdos. Políticos y Conducción", "Ayto. de Tolmacán", "Ayuntamiento de Tolmacan", "Ayuntamiento de Queltzaro", "GP ASR", "Grupo Parlamentario Alianza Serrana Renovadora"]
    df = spark.createDataFrame([("f", k, t) for k, t in enumerate(data)] + [("g", 100, data[0])], "field string, rep long, spelling string")
    e = body_entities(df, {"asr": "Alianza Serrana Renovadora"})
    pairs = {(r.field, r.rep_a, r.rep_b) for r in spelling_pairs(e).collect()}
    assert pairs == {("f", 0, 1), ("f", 0, 2), ("f", 1, 2), ("f", 3, 4), ("f", 6, 7)}


def test_variants_with_nothing_to_link(spark):
    rec = spark.createDataFrame([], "registro_id long, presentador string, partido string")
    parties = spark.createDataFrame([("ASR", "Alianza Serrana Renovadora"), (None, "x")], "siglas string, nombre string")
    roster = spark.createDataFrame([], "nombre string")
    args = ("registro_id", "presentador", "partido", roster, "nombre", parties, "siglas", "nombre", {"indep": "ZZZ"})
    assert variant_entities(rec, *args).count() == 0
    some = spark.createDataFrame([(1, None, None), (2, "Ana Ruiz", "asr"), (3, "Ana  Ruiz", "Alianza Serrana"), (4, "Ana Ruiz", " ")], rec.schema)
    got = {(r.field, r.rep): r.entity for r in variant_entities(some, *args).collect()}
    assert got[("presentador", 2)] == got[("presentador", 3)] and got[("partido", 2)] == got[("partido", 3)] and len(got) == 4
    assert spellings_of(some, "registro_id", "presentador").count() == 2


def test_values(spark):
    ref = spark.createDataFrame([(1, "Salud y Asistencia Médica"), (2, "Vivienda Digna"), (3, None), (1, "Salud y Asistencia Médica")], "id long, t string")
    c = read_catalog(ref, "id", "t")
    v = spark.createDataFrame([(1, "salud & asistencia", "x", 0), (2, None, None, 0), (3, "Vivienda  Dgina", "Astronomía", 0), (3, "Vivienda  Dgina", "", 0)], "rid long, a string, b string, value int")
    got = sorted((r.id, r.field, r.ref_id, r.how) for r in map_fields(v, "rid", {"a": c, "b": c}).collect() if r.field == "a" or r.how == "none")
    assert got == [(1, "a", 1, "cut"), (1, "b", -1, "none"), (2, "a", None, "missing"), (3, "a", 2, "entry"), (3, "a", 2, "entry"), (3, "b", -1, "none")]
    assert map_fields(v, "rid", {"a": c, "b": c}).count() == 8
    near = match_values(v, "a", Catalog([(1, "rojo"), (2, "roto")])).count()
    assert near == 2 and map_fields(v.limit(0), "rid", {"a": c}).count() == 0


def test_visual_text(spark):
    data = [(1, "Ｓuѕana", "x"), (2, None, None), (3, "", ""), (4, "Дружба", "y"), (4, "Дружба", "y"), (5, "José Ñ", "z"), (6, "a" * 200_000 + "​", "w")]
    df = spark.createDataFrame(data, "id int, t string, canonical string")
    got = [(r.id, r.canonical, r.needed_change) for r in canonical_text(df, "t").where("id < 6").orderBy("id").collect()]
    assert got == [(1, "Susana", True), (2, None, False), (3, "", False), (4, "Дружба", False), (4, "Дружба", False), (5, "José Ñ", True)]
    assert canonical_text(df.limit(0), "t").count() == 0
    again = canonical_text(canonical_text(df, "t"), "canonical", "twice", "again")
    assert again.where(F.col("again") | ~F.col("twice").eqNullSafe(F.col("canonical"))).count() == 0


def test_persons_off_the_roster_are_linked_by_whole_names(spark):
    people = ["Zulema Ortuño Baltierra", "Zulema Ortuno Baltiera", "ORTUÑO BALTIERRA ZULEMA", "Zulema Ortega Baltazar", "Rita Paz"]
    rows = [(k, p, "AB") for k, p in enumerate(people)]
    rec = spark.createDataFrame(rows, "id long, who string, party string")
    roster = spark.createDataFrame([("Ana Lucía Riplozuy Cigua",)], "name string")
    parties = spark.createDataFrame([("AB", "Alianza Buena")], "short string, name string")
    e = {r.spelling: r.entity for r in variant_entities(rec, "id", "who", "party", roster, "name", parties, "short", "name", {}).where("field = 'who'").collect()}
    assert e[people[0]] == e[people[1]] == e[people[2]] and len({e[people[0]], e[people[3]], e[people[4]]}) == 3


def test_large_cells_are_split_and_whole(spark, monkeypatch):
    import random

    from curul.llm import name_variants

    monkeypatch.setattr(name_variants, "CELL_BLOCK", 7)
    rng = random.Random(3)
    ws = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 8))) for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in ws], "word string")
    got = {(r.word, r.near) for r in name_variants.radius_join(df, df, pivots=3).collect()}
    radius = lambda w: 0 if len(w) < 3 else 1 if len(w) < 4 else 2 if len(w) < 9 else 3
    assert got == {(a, b) for a in ws for b in ws if levenshtein(a, b) <= radius(a)}


def test_one_search_gives_all_candidates(spark):
    v = spark.createDataFrame([(k, "roxo" if k % 3 else "rojo", "roto") for k in range(60)] + [(99, None, "")], "id int, a string, b string")
    c = Catalog([(1, "rojo"), (2, "roto")])
    out = {(r.id, r.field): r for r in map_fields(v, "id", {"a": c, "b": c}).collect()}
    assert len(out) == 122 and {x.ref_id for x in out[1, "a"].candidates} == {1, 2} and out[0, "a"].how == "exact" and out[0, "b"].ref_id == 2
    assert out[99, "a"].how == out[99, "b"].how == "missing" and out[99, "a"].candidates == []
