import re

from curul.llm.personal_info import PLACEHOLDERS, find_personal, name_span, proposals, redact

NAMES = ["Ana Lucía Riplozuy Cigua", "Mario Tumbre Dozol", "Elena Macul Rovira", "José Gembre Lonto", "Ana Dozol Macul", "Mario Cigua Gembre", "Elena Tumbre Lonto", "José Rovira Riplozuy"]


def corpus():
    out = []
    for k, n in enumerate(NAMES * 3):
        out.append(f"Buenas tardes: \nNombre: {n}\nDirección: Av. Norte 14, 97{k} col. El Roble, C.P. 0020{k % 10}\nTel: +52 1 155 123 45 {k:02d} ext. 44")
        out.append(f"Atentamente, {n}. Tel. 155 42{k % 10} 33{k:02d}. Se turnó a la Comisión de Salud el expediente 55512345{k:02d} con folio 12/2024.")
        out.append(f"Presentó CURP ABCD99010{k % 10}HQXABC0{k % 10} como identificación. Presentó NSS 12-34-56-78{k:02d}-9 como identificación. Presentó registro 40106{k:02d} ayer.")
    out += [
        "Siendo las 10:00, la Dip. Ana Dozol Macul presentó la Ley General de Aguas. La Escuela «Mario Tumbre» abrió.",
        "El C. Cigua Gembre, Mario pidió la palabra. Soy E. Macul Rovira y vivo en Calle del Río s/n.",
        "Escribir a ana.dozol+x@mail.example.org, e.macul [at] uni.test o mario (arroba) correo punto example; ver https://x.example/doc/1 de @congreso_x.",
        "", None, "Sin nada.",
    ]
    return out


def found(spark, texts):
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc long, text string, id string")
    return df, [(r.id, r.tipo, texts[r.id][r.inicio : r.fin]) for r in find_personal(df, "doc", "text").collect()]


def test_found(spark):
    texts = corpus()
    _, got = found(spark, texts)
    by = lambda k: sorted(v for _, t, v in got if t == k)
    assert by("name") == sorted([*NAMES * 6, "Cigua Gembre, Mario", "E. Macul Rovira"])
    assert by("email") == sorted(["ana.dozol+x@mail.example.org", "e.macul [at] uni.test", "mario (arroba) correo punto example"])
    assert len(by("phone")) == 48 and not any("55512345" in v for v in by("phone"))
    assert len(by("identity")) == 48 and not any("40106" in v for v in by("identity"))
    assert by("address") == sorted([*[f"Av. Norte 14, 97{k} col. El Roble, C.P. 0020{k % 10}" for k in range(24)], "Calle del Río s/n"])


def test_redaction_changes_nothing_else(spark):
    texts = corpus()
    df, got = found(spark, texts)
    out = {r.doc: r.redacted for r in redact(df, "doc", "text").collect()}
    for k, t in enumerate(texts):
        if t is None:
            assert out[k] is None
            continue
        spans = [v for d, _, v in got if d == k]
        parts = re.split("|".join(PLACEHOLDERS.values()), out[k])
        assert len(parts) == len(spans) + 1 and len("".join(parts)) == len(t) - sum(map(len, spans))


def test_nothing_and_very_long(spark):
    df = spark.createDataFrame([], "doc long, text string")
    assert find_personal(df, "doc", "text").count() == 0 and redact(df, "doc", "text").count() == 0
    for t in ("9" * 200_000, "A" * 200_000, "Ana Ruiz, " * 20_000, "a@" * 50_000, "1 2 3 " * 30_000, "C. A. " * 30_000, "Calle Norte " * 20_000):
        proposals(t)


def test_name_span():
    known = {"ana": True, "mario": True, "cigua": False, "gembre": False}
    run = lambda r, t="": (lambda s: s and (r + (", " + t if t else ""))[s[0] : s[1]])(name_span(r, t, known))
    assert run("Habla Ana Cigua Gembre") == "Ana Cigua Gembre" and run("El C. Mario Cigua") == "Mario Cigua" and run("A. Cigua Gembre") == "A. Cigua Gembre"
    assert run("Cigua Gembre", "Ana") == "Cigua Gembre, Ana" and run("Ana Mario") is None and run("Ana de la Cigua") == "Ana de la Cigua" and run("Ley General") is None and run("Cigua Gembre", "Col") == "Cigua Gembre"
    assert run("Ma. Cigua Gembre") == "Ma. Cigua Gembre" and run("Ana Fco. Cigua") == "Ana Fco. Cigua" and run("Cigua Gembre", "Gpe.") == "Cigua Gembre, Gpe."
    texts = [p[-2:] for t in ("Soy Ma. Cigua Gembre y digo", "firman Cigua Gembre, Fco.; otro", "el PLENO. Ana Cigua habló") for p in proposals(t) if p[0] == "run"]
    assert texts == [("Soy Ma. Cigua Gembre", ""), ("Cigua Gembre", "Fco."), ("Ana Cigua", "")]


def test_head_words_and_quotes_hide_no_name(spark):
    more = ["Se turna a Dirección Ana Dozol Macul. Consta.", "Vista: el Acta Mario Cigua Gembre dijo.", "Así dijo «Elena Tumbre Lonto» ayer.", "La Medalla «Elena Tumbre Lonto» y la escuela primaria «Mario Cigua» y el Premio “José Gembre Lonto”.", f"Habló {'W' + 'x' * 60} con Ana Dozol Macul."]
    texts = corpus() + more
    _, got = found(spark, texts)
    names = {k: sorted(v for d, t, v in got if d == len(texts) - len(more) + k and t == "name") for k in range(len(more))}
    assert names == {0: ["Ana Dozol Macul"], 1: ["Mario Cigua Gembre"], 2: ["Elena Tumbre Lonto"], 3: [], 4: ["Ana Dozol Macul"]}


def test_long_local_part():
    for n in (10, 64, 90):
        (p,) = [p for p in proposals(f"correo {'a' * n}@mail.example.org.") if p[0] == "email"]
        assert p[2] - p[1] == n + len("@mail.example.org")


def test_well_formed_but_never_personal(spark):
    """Written-out signs are turned away where all that is known of their surroundings speaks against them."""
    texts = [f"Correo: m{k}@uni.test y fin" for k in range(24)] + ["versión v1 (at) main.core en repositorio"] * 40 + ["Correo: ana (at) uni.test y fin"]
    _, got = found(spark, texts)
    mails = [v for _, t, v in got if t == "email"]
    assert len(mails) == 25 and "ana (at) uni.test" in mails
