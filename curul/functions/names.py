"""Names of persons, bodies and parties as typed: parsing and comparison, as plain Python."""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache

from curul.functions.lexicon import CONTRACTIONS, LINK_WORDS, levenshtein
from curul.functions.unicode_text import canonical, fold

# Titles before a person's name.
TITLES = frozenset("dip diputado diputada diputados c ciudadano ciudadana lic licenciado licenciada dr dra doctor doctora ing ingeniero ingeniera mtro mtra maestro maestra prof profr profra profesor profesora arq arquitecto arquitecta sr sra srta senor senora don dona sen senador senadora".split())
# Common short and pet forms of Spanish given names.
SHORT_GIVEN = {
    "ma": "maria", "mari": "maria", "maru": "maria eugenia", "fco": "francisco", "paco": "francisco", "pancho": "francisco", "fdo": "fernando", "fer": "fernando", "nando": "fernando",
    "gpe": "guadalupe", "lupe": "guadalupe", "lupita": "guadalupe", "gmo": "guillermo", "memo": "guillermo", "igno": "ignacio", "nacho": "ignacio", "ml": "manuel", "meno": "manuel", "manolo": "manuel", "manu": "manuel",
    "alej": "alejandra alejandro alejandrina", "ale": "alejandra alejandro", "ant": "antonio antonia", "tono": "antonio", "tona": "antonia", "conc": "concepcion", "concha": "concepcion", "conchita": "concepcion",
    "j": "jose jesus juan", "pepe": "jose", "pepita": "josefina", "pepa": "josefa josefina", "chepina": "josefina", "fina": "josefina", "chuy": "jesus", "chucho": "jesus", "lalo": "eduardo", "poncho": "alfonso", "quique": "enrique", "kike": "enrique",
    "chava": "salvador", "chela": "graciela", "quena": "eugenia", "quenia": "eugenia", "meche": "mercedes", "rosy": "rosalba rosa rosario rosalia", "rosi": "rosalba rosa rosario", "paty": "patricia", "pati": "patricia", "coco": "socorro", "goyo": "gregorio", "gaby": "gabriela gabriel", "gabi": "gabriela",
    "bety": "beatriz", "beti": "beatriz", "tere": "teresa", "rafa": "rafael", "adri": "adriana", "chabela": "isabel", "chave": "isabel", "isa": "isabel", "beto": "alberto roberto norberto gilberto humberto heriberto", "lola": "dolores", "vero": "veronica", "chente": "vicente", "lety": "leticia", "leti": "leticia",
    "tavo": "gustavo octavio", "gus": "gustavo", "polo": "leopoldo", "licha": "alicia", "lucha": "lucia luz", "moni": "monica", "lulu": "lourdes", "caro": "carolina", "chayo": "rosario", "charo": "rosario", "neto": "ernesto", "nico": "nicolas", "rodo": "rodolfo", "rolo": "rodolfo", "fito": "rodolfo adolfo", "richi": "ricardo", "rica": "ricardo",
    "sergi": "sergio", "checo": "sergio", "tomi": "tomas", "tomy": "tomas", "yola": "yolanda", "yoli": "yolanda", "lili": "liliana lilia", "lila": "liliana", "mago": "margarita", "mague": "margarita", "rita": "margarita", "chole": "soledad", "nena": "elena", "vale": "valentin", "zaca": "zacarias", "wences": "wenceslao", "uli": "ulises", "julian": "julian", "julito": "julio",
    "marce": "marcelino marcela", "chelino": "marcelino", "efra": "efrain", "balta": "baltazar", "joaco": "joaquin", "quino": "joaquin quirino", "moncho": "ramon", "mon": "ramon", "mundo": "edmundo raimundo", "arqui": "arturo", "turo": "arturo", "tito": "ernesto roberto", "robe": "roberto", "pilo": "porfirio", "pfo": "porfirio", "roge": "rogelio", "hila": "hilario", "layo": "hilario", "dario": "dario",
    "chio": "rocio", "ro": "rocio", "chiva": "silvia", "silvi": "silvia", "nadi": "nadia", "kari": "karina", "claus": "claudia", "clau": "claudia", "ofe": "ofelia", "delfi": "delfina", "gris": "griselda", "jacin": "jacinta", "chinta": "jacinta", "ame": "amalia", "mali": "amalia", "cuca": "refugio", "ara": "araceli", "cheli": "araceli", "sara": "sara", "susi": "susana", "susy": "susana", "mine": "ines", "marti": "martha", "normita": "norma", "esthercita": "esther", "auro": "aurora", "josefa": "josefa", "jva": "javier", "javi": "javier", "rdo": "ricardo", "eduo": "eduardo", "mgta": "margarita", "dgo": "domingo", "feo": "federico", "alf": "alfonso", "alb": "alberto", "edo": "eduardo", "gab": "gabriel gabriela", "rob": "roberto", "carm": "carmen", "carmelita": "carmen", "luchita": "lucia", "esp": "esperanza", "vte": "vicente", "pbro": "", "franc": "francisco", "bdo": "bernardo", "berna": "bernardo", "sto": "santos",
}
# Those short forms that are written with a dot.
DOTTED_GIVEN = ("ma", "ml", "fco", "fdo", "gpe", "gmo", "ant", "rdo", "alf", "alb", "bdo", "vte", "igno", "alej", "conc", "mgta", "carm")
# Words that make a presenter a body rather than a person.
BODY_WORDS = frozenset("junta mesa directiva grupo parlamentario parlamentaria bancada fraccion ayuntamiento ayto municipio municipal cabildo colegio universidad univ tribunal trib consejo cons comision com comite titular ejecutivo poder gobierno gobernador congreso legislatura politecnica instituto secretaria fiscalia procuraduria camara asociacion sindicato federacion organismo auditoria contraloria direccion acuerdos acdos arbitraje notarios gp jta coordinacion partido presidencia".split())


def tokens(text: str) -> list[tuple[str, bool]]:
    """(folded word, written with a dot) in order."""
    return [(m.group(1), bool(m.group(2))) for m in re.finditer(r"([a-z0-9]+)(\.?)", fold(text))]


def acronym(text: str) -> str | None:
    """The letters of a value that is nothing but capitals or dotted letters, as GP ASR, J.C.A.P. or C. N. E."""
    t = canonical(text)[0].strip().rstrip(".,")
    if re.fullmatch(r"(?:[A-Za-z]\.\s*)+[A-Za-z]", t) or re.fullmatch(r"[A-Z]{2,6}", t):
        return fold(re.sub(r"[^A-Za-z]", "", t))
    return None


def is_body(text: str) -> bool:
    """Whether a presenter is a body: it holds a word that says so, spelled well or nearly, or is an acronym."""
    if acronym(text):
        return True
    ts = tokens(text)
    if re.match(r"g\.?\s*p\.?\s", fold(text)):
        return True
    return any(w in BODY_WORDS and (w not in ("com", "cons", "partido") or d) for w, d in ts) or any(len(w) >= 5 and (_near_body(w)) for w, _ in ts)


@lru_cache(maxsize=100_000)
def _near_body(w: str) -> bool:
    return any(len(b) >= 7 and levenshtein(w, b, 2) <= (1 if len(b) < 8 else 2) for b in BODY_WORDS)


def person_words(text: str) -> list[str]:
    """Folded words of a person's name without titles and particles; short forms and initials stay as typed."""
    ts = tokens(text)
    while ts and ts[0][0] in TITLES and len(ts) > 2:
        ts = ts[1:]
    return [w for w, _ in ts if w not in ("de", "del", "la", "las", "los", "y")]


def given_readings(w: str, given: list[str]) -> list[str]:
    """Official given names (sorted) that a short form or a beginning may stand for."""
    at = lambda x: bisect_left(given, x)
    out = [g for g in SHORT_GIVEN.get(w, "").split() if given[at(g) : at(g) + 1] == [g]]
    if not out and len(w) >= 3:
        out = [g for g in given[at(w) : at(w + "\uffff")] if g != w]
    return out


def person_cost(words: list[str], official: list[str]) -> float:
    """How far a typed name is from an official one (given names, then two surnames); 99 when it can't be it.

    Every typed word must stand for a different official word: as it is, within a few edits, as short form, or as
    initial. The first given name and the first surname must be among those met; others may be missing.
    """
    n = len(official)
    first, last = 0, max(1, n - 2)
    used: set[int] = set()
    total = 0.0
    options = []
    for w in words:
        o = []
        for k, v in enumerate(official):
            if w == v:
                c = 0.0
            elif len(w) == 1:
                c = 0.4 if v[0] == w else 99.0
            elif k < last and v in SHORT_GIVEN.get(w, "").split():
                c = 0.3
            elif len(w) >= 3 and len(w) <= 5 and v.startswith(w) and k < last:
                c = 0.6
            else:
                d = levenshtein(w, v, 3)
                c = float(d) if d <= (3 if len(v) > 8 else 2) and d < max(len(w), 3) else 99.0
            if c < 99:
                o.append((c, k))
        if not o:
            return 99.0
        options.append(sorted(o))
    for o in sorted(options, key=lambda o: (len(o), o[0][0])):
        pick = next(((c, k) for c, k in o if k not in used), None)
        if pick is None:
            return 99.0
        total += pick[0]
        used.add(pick[1])
    if first not in used or last not in used:
        return 99.0
    return total + 0.05 * (n - len(used))


# Words of bodies that stand for one another.
SAME_WORD = {"municipio": "ayuntamiento", "estado": "estatal", "bancada": "grupo", "fraccion": "grupo", "gobernador": "ejecutivo"}


def body_words(text: str, party_names: dict[str, str] | None = None) -> list[str]:
    """Content words of a body or party, short forms of fixed kind written out."""
    t = re.sub(r"\bg\.?\s*p\.?(?=\s)", "grupo parlamentario", fold(text)) if re.match(r"g\.?\s*p\.?\s", fold(text)) else fold(text)
    t = re.sub(r"\((.*?)\)", " ", t)
    t = re.sub(r",\s*a\.?\s*[pc]\.?\s*$", "", t)
    t = re.sub(r"^(?:h|la|el)\b\.?\s+", "", t.strip())
    out = []
    for w, dot in ((m.group(1), bool(m.group(2))) for m in re.finditer(r"([a-z0-9]+)(\.?)", t)):
        if party_names and w in party_names:
            out += body_words(party_names[w])
        elif w not in LINK_WORDS:
            w = CONTRACTIONS.get(w, w) if dot or w in ("jta", "ayto", "acdos") else w
            out.append(SAME_WORD.get(w, w) + ("." if dot and len(w) <= 6 and w not in CONTRACTIONS.values() else ""))
    return out


def _word_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if a.endswith(".") or b.endswith("."):
        s, o = (a, b) if a.endswith(".") else (b, a)
        s, o = s.rstrip("."), o.rstrip(".")
        if o.startswith(s) or s.startswith(o):
            return 0.3
        return 1.0 if len(s) >= 3 and levenshtein(s, o[: len(s)], 1) <= 1 else 99.0
    d = levenshtein(a, b, 2)
    if len(a) == len(b) >= 4 and sorted(a) == sorted(b):
        return float(d) if d <= 2 else 99.0
    return float(d) if d <= (0 if min(len(a), len(b)) < 4 else 1 if min(len(a), len(b)) < 6 else 2) else 99.0


def same_body(a: list[str], b: list[str], most: float = 4.0, spare: int = 2) -> bool:
    """Whether two word lists name one body or party: each word of the shorter stands for a different word of the longer,
    order aside, and at most ``spare`` words of the longer are left. A single word only matches beside one other."""
    if len(a) > len(b):
        a, b = b, a
    if not a or len(b) - len(a) > (spare if len(a) > 1 else 0):
        return False
    used: set[int] = set()
    total = 0.0
    for w in sorted(a, key=lambda x: (x.endswith("."), -len(x))):
        c, k = min(((_word_cost(w, v), k) for k, v in enumerate(b) if k not in used), default=(99.0, -1))
        if c >= 99:
            return False
        total += c
        used.add(k)
    return total <= most


def acronym_keys(words: list[str]) -> list[str]:
    """Acronyms a body of these words may go by: the initials, or with one more letter of its last word."""
    ws = [w.rstrip(".") for w in words]
    first = "".join(w[0] for w in ws)
    out = {first} if len(ws) > 1 else set()
    if len(ws) >= 2 and all(len(w) > 2 for w in ws):
        out |= {first + c for c in ws[-1][1:]}
    return sorted(out)
