"""Personal information in free text by bootstrapped contextual extraction.

One pass over the texts proposes instances by their shape (runs of capitalised words, runs of digits, register codes,
addresses of e-mail and street) with the words around them. A few seeds per type start the bootstrapping: seed
instances make the contexts they stand in into patterns, patterns make further instances, and both are scored on the
aggregated graph of contexts and instances, round by round. Contexts and shapes that reach high confidence then decide
on instances never seen as seeds: ten digits after "expediente" stay, ten digits after "cel." go. The texts are read
once; what is kept of them until the end are the proposals.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curul.functions.names import DOTTED_GIVEN
from curul.functions.unicode_text import fold
from curul.plans.state import cut, stored

PLACEHOLDERS = {"email": "<EMAIL>", "phone": "<PHONE>", "identity": "<IDENTITY>", "address": "<ADDRESS>", "name": "<NAME>"}
#: Contexts that start the bootstrapping of names.
NAME_SEEDS = ("nombre :", "me llamo", "atentamente ,", "suscribe ,")
ROUNDS = 3

_LOCAL = r"[A-Za-z0-9][A-Za-z0-9._+-]*"
_AT = r"(?: ?@ ?| ?[\[({] ?(?:at|arroba) ?[\])}] ?| (?:arroba|ARROBA) )"
_DOT = r"(?:\.| ?[\[({] ?(?:dot|punto) ?[\])}] ?| (?:punto|PUNTO) )"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
# The expressions that run over whole texts begin with a plain set of characters, which the engine skips to quickly;
# what must not stand before a match is looked at afterwards.
AT_SIGN = re.compile(rf"@|[\[({{] ?(?:at|AT|arroba|ARROBA) ?[\])}}]|arroba|ARROBA")
EMAIL = re.compile(rf"{_LOCAL}{_AT}{_LABEL}(?:{_DOT}{_LABEL})+")
_LOCAL_SIGNS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._+-")

DIGITS = re.compile(r"[+(\d][\d ().-]{5,}\d")
NUMBER = re.compile(r"(?<![\w$/.,:#+-])\+?(?:\d+ )?(?:\(\d{2,3}\) ?)?\d+(?:[ .-]\d+)*(?![\w/]|[.,:-]\d)")
SIX = re.compile(r"\d{6}")
CODE = re.compile(r"(?<![\w/-])(?:[A-Za-z]{4}[ -]?\d{6}[ -]?[HMhm][A-Za-z]{5}[ -]?[A-Za-z0-9]\d|[A-Za-z]{6}[ -]?\d{8}[ -]?[HMhm]\d{3}|[A-Za-z]{4}[ -]?\d{6}[ -]?[A-Za-z0-9]{3}|[A-Za-z][ -]?\d{8})(?![\w/]|-\d)")

# Words for kinds of streets, districts and inner numbers.
STREET_KINDS = "avenida av. avda. calle calz. calzada blvd. boulevard bulevar privada priv. cerrada cda. callejón callejon andador and. circuito cto. prolongación prolongacion prol. camino carretera paseo retorno periférico pasaje".split()
_KIND = "(?:" + "|".join(sorted({re.escape(f(k)) for k in STREET_KINDS for f in (str.lower, str.upper, str.capitalize)} | {r"C\."}, reverse=True)) + ")"
_UP = r"[A-ZÁÉÍÓÚÜÑ]"
_SWORD = rf"(?:{_UP}[^\W\d_]*|\d+[°ºª]?|de|del|la|las|los|el|y)"
_HOUSE = r"(?:(?:,? ?(?:[Nn]o\.?|N[oO]\.|[Nn][úu]m\.?|N[ÚU]M\.|[Nn][úu]mero|N[ÚU]MERO|#) ?| ?, ?| )\d{1,5}(?: ?- ?[A-Za-z]\b| [A-Z]\b(?!\.))?|,? [Ss]/[Nn]|,? S/N|,? sin n[úu]mero|,? (?:[Mm]z|MZ|[Mm]anzana)\.? ?\d+,? (?:[Ll]t|LT|[Ll]ote)\.? ?\d+)"
_INNER = r"(?:,? (?:[Ii]nt|INT|[Ii]nterior|[Dd]epto|[Dd]pto|[Ll]t|[Ll]ote|[Mm]z)\.? ?(?:\d+(?:-?[A-Z]\b)?|[A-Z]\b))"
_DNAME = rf"(?:{_UP}[^\W\d_]+|\d+)(?: (?:(?:de|del|la|las|los|el|y) )*(?:{_UP}[^\W\d_]+|\d+(?!\d)))*"
_DISTRICT = rf"(?:,? (?:[Cc]ol|COL|[Cc]olonia|COLONIA|[Ff]racc|FRACC|[Ff]raccionamiento|[Bb]arrio|[Uu]nidad|[Uu]\.? ?[Hh]|[Ee]jido|[Cc]omunidad)\b\.? {_DNAME})"
_POSTAL = r"(?:,? (?:C\. ?P\.?|CP|c\.p\.|[Cc]ódigo [Pp]ostal) ?\d{5})"
ADDRESS = re.compile(rf"{_KIND} {_SWORD}(?: {_SWORD}){{0,7}}{_HOUSE}(?![\d/]){_INNER}?{_DISTRICT}?{_POSTAL}?")

_SAID = re.compile(rf"(?:[Nn]o\.|N[oO]\.|[Nn][úu]m|N[ÚU]M|#|[Ss]/[Nn]|S/N|sin n[úu]mero|{_DISTRICT}|{_POSTAL})")

_ABBREVIATED = [a for d in DOTTED_GIVEN for a in (d.capitalize(), d.upper())]
_BY_LENGTH = "|".join("(?<=" + "|".join(rf"{a}\." for a in _ABBREVIATED if len(a) == n) + ")" for n in sorted({len(a) for a in _ABBREVIATED}))
# Words don't backtrack and runs begin only at the beginning of a word, so a text without spaces costs no more than
# another. A dot belongs to a word only as that of an initial or a short given name.
_LONG = rf"[^\W\d_]++(?:\.(?:{_BY_LENGTH}))?"
_W = rf"{_UP}(?:{_LONG}|\.)"
_PART = r"(?:(?:de la|de las|de los|del|de|DE LA|DE LAS|DE LOS|DEL|DE) )?"
RUN = re.compile(rf"{_UP}(?<![^\W\d_].)(?:{_LONG}|\.)(?:(?: {_PART}{_W})+|(?=, {_UP}))")
TAIL = re.compile(rf", ({_UP}{_LONG}(?: {_UP}{_LONG})?)")
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|\n|\t")
# The office that deputies are always named with.
OFFICE = ("dip.", "dips.", "dip", "diputado", "diputada", "diputados", "diputadas")

# Words for what is named after persons in quotation marks.
NAMED_AFTER = frozenset("medalla presea premio escuela primaria secundaria preparatoria bachillerato jardín plantel instituto colegio".split())


def _names_a_thing(text: str, quote: int) -> bool:
    """Whether a quotation mark opens the name of a medal, a school or the like: the word before it is such a word, or
    is capitalised itself."""
    before = text[max(0, quote - 60) : quote].split()
    return bool(before) and text[quote - 1] == " " and (before[-1].lower() in NAMED_AFTER or before[-1][0].isupper() and before[-1].isalpha())


def _left(text: str, at: int) -> tuple[str, str]:
    """Last two tokens before a place and the last of them that is no stop or colon, folded; ^ at a sentence's start."""
    ts = _TOKEN.findall(text[max(0, at - 32) : at])[-2:]
    if not ts or ts[-1] in ".:\n" and (len(ts) < 2 or ts[-1] == "\n"):
        return "^", "^"
    ts = ["9" if t.isdigit() else fold(t) for t in ts]
    if ts[-1] == "." and len(ts) > 1 and len(ts[0]) > 5:
        return "^", "^"
    return " ".join(ts), ts[0] if ts[-1] in ".:" and len(ts) > 1 else ts[-1]


def _right(text: str, at: int) -> str:
    return " ".join("9" if t.isdigit() else fold(t) for t in _TOKEN.findall(text[at : at + 28])[:2])


def proposals(text: str) -> list[tuple[str, int, int, str, str, str, str, str, str]]:
    """(kind, start, end, shape, left2, left1, right2, run, tail) of one text; spans in characters."""
    out = []
    taken: list[tuple[int, int]] = []  # in order, apart from one another

    def free(a: int, b: int) -> bool:
        k = bisect_left(taken, (b, 0))
        return not k or taken[k - 1][1] <= a

    last = 0
    for m in AT_SIGN.finditer(text):
        at = m.start()
        if at < last:
            continue
        end = at - (text[at - 1 : at] == " ")
        begin = end
        while begin > last and text[begin - 1] in _LOCAL_SIGNS:
            begin -= 1
        if begin == end or not text[begin].isalnum() or begin and (text[begin - 1] in "@/" or text[begin - 1].isalnum()):
            continue
        full = EMAIL.match(text, begin)
        if full and full.end() > at:
            signs = "@" if "@" in full.group() else "written"
            out.append(("email", full.start(), full.end(), signs, *_left(text, begin), _right(text, full.end()), "", ""))
            insort(taken, full.span())
            last = full.end()
    for m in ADDRESS.finditer(text):
        a, b = m.span()
        if not (a and (text[a - 1].isalnum() or text[a - 1] == "_")) and free(a, b):
            # a house number said to be one, a district or a postal code; or a mere number after the street
            said = "said" if _SAID.search(m.group()) else fold(m.group().partition(" ")[0])
            out.append(("address", a, b, said, *_left(text, a), _right(text, b), "", ""))
            insort(taken, (a, b))
    last = 0
    for m in SIX.finditer(text):
        a = m.start()
        if a < last or not a or not (text[a - 1].isalpha() or text[a - 1] in " -" and text[a - 2 : a - 1].isalpha()):
            continue
        c = CODE.search(text, max(0, a - 8), a + 26)
        # the search window must not cut the code or what stands around it
        if c and c.start() <= a < c.end() and (c.start() == 0 or not (text[c.start() - 1].isalnum() or text[c.start() - 1] in "/-")) and not text[c.end() : c.end() + 1].isalnum() and free(*c.span()):
            s = re.sub(r"[A-Za-z]", "A", re.sub(r"\d", "9", c.group()))
            out.append(("code", c.start(), c.end(), s if len(s) < 12 else f"long{len(re.sub(r'[^A9]', '', s))}", *_left(text, c.start()), _right(text, c.end()), "", ""))
            insort(taken, c.span())
            last = c.end()
    for run in DIGITS.finditer(text):
        a, b = run.span()
        if sum(map(str.isdigit, run.group())) < 7:
            continue
        for m in NUMBER.finditer(text, a, b):
            x, y = m.span()
            n = sum(map(str.isdigit, m.group()))
            if 7 <= n <= 14 and not (x and (text[x - 1].isalnum() or text[x - 1] in "$/.,:#+-")) and not (text[y : y + 1].isalnum() or text[y : y + 1] == "/" or text[y : y + 1] in ".,:-" and text[y + 1 : y + 2].isdigit()) and free(x, y):
                out.append(("number", x, y, f"{n}:" + re.sub(r"\d+", lambda g: str(len(g.group())), m.group()), *_left(text, x), _right(text, y), "", ""))
                insort(taken, (x, y))
    for m in RUN.finditer(text):
        a, b = m.span()
        while m and (a and (text[a - 1].isalnum() or text[a - 1] == "_") or not free(a, a + 1)):
            # the run began inside a word or an address: what follows its first space may still be one
            cut_at = text.find(" ", a, b)
            m = RUN.match(text, cut_at + 1, b + 2) if cut_at >= 0 else None
            a, b = m.span() if m else (a, b)
        if not m or a > 1 and text[a - 1] in "«“\"'" and _names_a_thing(text, a - 1) or not free(a, b) or text[max(0, a - 12) : a].rstrip().lower().endswith(OFFICE):
            continue
        t = TAIL.match(text, b)
        out.append(("run", a, b, "", *_left(text, a), "", m.group(), t.group(1) if t else ""))
    return out


_SCHEMA = "kind string, start int, stop int, shape string, left2 string, left1 string, right2 string, run string, tail string"


def propose(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All proposals of all texts, whole, with the id; null and empty texts give none."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", *[c.split()[0] for c in _SCHEMA.split(", ")]]
        for b in batches:
            rows = [(i, *p) for i, t in zip(b["id"], b["text"]) if t for p in proposals(t)]
            yield pd.DataFrame(rows, columns=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL").mapInPandas(scan, f"id {id_type}, {_SCHEMA}")


PATTERNS = ("left2", "left1", "right2", "shape")


def score_shapes(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, shape, left2, left1, right2, tipo) of the proposals with a shape that the bootstrapping takes for a type.

    Seeds are the shapes that can be nothing else: international prefixes for phones, long register codes for identity,
    e-mail with its sign, addresses that say their number, district or postal code. Each round, a pattern (context or
    shape) is scored by the share of its instances so typed. Numbers and codes get a type in contexts of at least the
    round's confidence, or with a shape most of whose instances are so typed. E-mail with its signs written out and
    streets with a mere number are well formed, so they are turned away only where every pattern seen elsewhere speaks
    against them.
    """
    group = F.when(F.col("kind").isin("number", "code"), "digits").otherwise(F.col("kind"))
    e = found.where("kind <> 'run'").groupBy("kind", *PATTERNS).agg(F.count("*").alias("n")).withColumn("grp", group)
    digits = F.split("shape", ":")[0].try_cast("int")
    may = {"phone": (F.col("kind") == "number") & F.coalesce(digits.isin(7, 10, 12, 13, 14), F.lit(False)), "identity": (F.col("kind") == "code") | ((F.col("kind") == "number") & F.coalesce(digits == 11, F.lit(False))), "formed": F.col("kind").isin("email", "address")}
    seed = {"phone": (F.col("kind") == "number") & F.col("shape").rlike(r"^1[0-4]:(\+|4 )"), "identity": F.col("shape").startswith("long"), "formed": F.col("shape").isin("@", "said")}
    types = list(may)
    e = cut(e.withColumn("edge", F.concat_ws("\x01", "kind", *PATTERNS)).withColumns({f"is_{t}": seed[t] & may[t] for t in types}))
    for k in range(rounds):
        least = 0.08 if k == 0 else 0.5
        side = e.select("edge", "grp", "n", *[f"is_{t}" for t in types], F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(p).alias("v")) for p in PATTERNS])).alias("x")).select("*", "x.*").drop("x")
        typed = lambda t: F.sum(F.when(F.col(f"is_{t}"), F.col("n")).otherwise(0))
        score = side.groupBy("grp", "p", "v").agg(F.sum("n").alias("all"), *[typed(t).alias(f"in_{t}") for t in types])
        share = lambda p, t: F.max(F.when(F.col("p") == p, F.col(f"in_{t}") / F.col("all"))).alias(f"{p}_{t}")
        # what the other instances of the pattern say, with one half instance either way in thought
        others = F.max((F.col("in_formed") - F.col("is_formed").cast("int") + 0.5) / F.col("all")).alias("others")
        votes = side.join(score, ["grp", "p", "v"]).groupBy("edge").agg(*[share(p, t) for p in PATTERNS for t in ("phone", "identity")], others)
        e = e.join(votes, "edge")
        new = {}
        for t in ("phone", "identity"):
            near = (F.col(f"left2_{t}") >= least) | (F.col(f"left1_{t}") >= max(least, 0.5)) | ((F.col(f"right2_{t}") >= 0.3) & (F.lit(t) == "identity"))
            new[f"is_{t}"] = may[t] & (F.col(f"is_{t}") | near | (F.col(f"shape_{t}") >= 0.6))
        new["is_formed"] = may["formed"] & (F.col("is_formed") | (F.col("others") >= 0.3))
        e = cut(e.withColumns(new).select("edge", "grp", "kind", *PATTERNS, "n", *[f"is_{t}" for t in types]))
    return e.select("kind", *PATTERNS, F.when(F.col("is_identity"), "identity").when(F.col("is_phone"), "phone").when(F.col("is_formed"), F.col("kind")).alias("tipo")).where("tipo IS NOT NULL")


def score_words(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(word, given): words the bootstrapping takes for parts of personal names, and whether they are given names.

    The graph joins contexts before runs of capitalised words with the words of the runs. A context's score is the
    share of its words that are name words, a word's score the share of its occurrences in name contexts. The beginning
    of a sentence (^) counts against words as any other context, but is never a name context.
    """
    word = found.where("kind = 'run'").select("left2", F.posexplode(F.split(F.regexp_replace(fold_names("run"), r"\b(de|del|la|las|los)\b", " "), r"\s+")).alias("k", "word")).where("length(word) > 2 AND NOT word LIKE '%.'")
    e = cut(word.groupBy("left2", "word").agg(F.count("*").alias("n"), F.sum((F.col("k") == 0).cast("int")).alias("first")))
    of_word = e.groupBy("word").agg(F.sum("n").alias("all"))
    of_context = e.where("left2 <> '^'").groupBy("left2").agg(F.sum("n").alias("all"))
    seeds = found.sparkSession.createDataFrame([(c,) for c in NAME_SEEDS], "left2 string")
    contexts = seeds
    for k in range(rounds):
        inside = e.join(contexts, "left2").groupBy("word").agg(F.sum("n").alias("inside"))
        names = inside.join(of_word, "word").where(F.col("inside") >= (0.02 if k == 0 else 0.3) * F.col("all")).select("word")
        held = e.where("left2 <> '^'").join(names, "word").groupBy("left2").agg(F.sum("n").alias("inside"))
        contexts = cut(held.join(of_context, "left2").where("inside >= 0.85 * all").select("left2").unionByName(seeds).distinct())
    g = e.join(contexts, "left2").groupBy("word").agg(F.sum("n").alias("inside"), F.sum("first").alias("first"))
    return g.join(of_word, "word").where("inside >= 0.3 * all").select("word", (F.col("first") >= 0.5 * F.col("inside")).alias("given"))


def fold_names(c: str) -> Column:
    from curul.functions.text import fold as fold_col

    return fold_col(c)


def name_span(run: str, tail: str, known: dict[str, bool]) -> tuple[int, int] | None:
    """(start, end) of the personal name inside a run and what follows a comma; None when there is none.

    ``known`` maps folded name words to whether they are given names. A name has two words at least, an initial
    counting as one, of which one is no given name; particles between them belong to it. "Surname Surname, Given" is one.
    """
    ts = [(m.start(), m.end(), fold(m.group().rstrip("."))) for m in re.finditer(r"[^\W\d_]+\.?", run)]
    known = known | {w: True for a, b, w in ts if run[b - 1] == "." and w in DOTTED_GIVEN} | {w[:-1]: True for w in fold(tail or "").split() if w[:-1] in DOTTED_GIVEN}
    best: tuple[int, int] | None = None
    k = 0
    while k < len(ts):
        if ts[k][2] not in known and not (len(ts[k][2]) == 1 and run[ts[k][1] - 1] == "."):
            k += 1
            continue
        j, words, last = k, [], k
        while j < len(ts):
            w = ts[j][2]
            if w in known:
                words.append((j, w))
                last = j
            elif w in ("de", "del", "la", "las", "los") and words:
                pass
            elif len(w) == 1 and run[ts[j][1] - 1] == ".":
                words.append((j, w))
                last = j
            else:
                break
            j += 1
        tw = [fold(w).rstrip(".") for w in tail.split()] if tail and j >= len(ts) else []
        turned = bool(tw) and all(known.get(w) for w in tw)
        while len(words) > 1 and len(words[0][1]) == 1 and (known.get(words[1][1], len(words[1][1]) == 1) or turned or k and ts[k - 1][2] in ("el", "la")):
            words = words[1:]  # "C. Rodolfo ...", "El C. ...": a title, not an initial
        real = [w for _, w in words if len(w) > 1]
        if real:
            a, b = ts[words[0][0]][0], ts[last][1]
            joined = turned and not any(known[w] for w in real)
            if joined:
                b = len(run) + 2 + len(tail)
            if joined or len(words) >= 2 and not all(known[w] for w in real):
                if best is None or b - a > best[1] - best[0]:
                    best = (a, b)
        k = max(j, k + 1)
    return best


def find_personal(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tipo, inicio, fin): every personal detail located, in characters of the text, end exclusive.

    Null and empty texts have none; names in rows with a null id aren't located. Ids must be unique. Spans of one text
    don't overlap; an address keeps the names inside it. Other columns, whatever their names, play no part.
    """
    found = stored(propose(docs, id_col, text_col))
    shaped = found.where("kind <> 'run'").join(score_shapes(found), ["kind", *PATTERNS]).select("id", "tipo", F.col("start").alias("inicio"), F.col("stop").alias("fin"))
    vocab = cut(score_words(found))
    runs = found.where("kind = 'run'").select("id", "start", "run", "tail")
    parts = F.split(F.regexp_replace(fold_names("run"), r"[^\p{L}]+", " "), " ")
    tails = F.split(fold_names("tail"), " ")
    known = runs.select("id", "start", F.explode(F.array_distinct(F.concat(parts, tails))).alias("word")).join(vocab, "word").groupBy("id", "start").agg(F.map_from_entries(F.collect_list(F.struct("word", "given"))).alias("known"))

    @F.pandas_udf("struct<a int, b int>")
    def span(run: pd.Series, tail: pd.Series, words: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([name_span(r, t, dict(k)) or (None, None) for r, t, k in zip(run, tail, words)], columns=["a", "b"]).astype("Int32")

    named = runs.join(known, ["id", "start"]).select("id", "start", span("run", "tail", "known").alias("s")).where("s.a IS NOT NULL")
    names = named.select("id", F.lit("name").alias("tipo"), (F.col("start") + F.col("s.a")).alias("inicio"), (F.col("start") + F.col("s.b")).alias("fin"))
    return shaped.unionByName(names)


def redact(docs: DataFrame, id_col: str, text_col: str, out_col: str = "redacted") -> DataFrame:
    """All rows and columns, with the text in which every personal detail is a typed placeholder, the rest unchanged.

    Null texts stay null, texts without personal details stay as they are, as do texts of rows with a null id. A column
    of the name ``out_col`` is replaced.
    """
    spans = find_personal(docs, id_col, text_col).groupBy(F.col("id").alias("__doc")).agg(F.sort_array(F.collect_list(F.struct("inicio", "fin", "tipo"))).alias("__spans"))

    @F.pandas_udf("string")
    def replace(texts: pd.Series, all_spans: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(texts, all_spans):
            if t is None or spans is None:
                out.append(t)
                continue
            parts, at = [], 0
            for s in spans:
                if s["inicio"] >= at:
                    parts += [t[at : s["inicio"]], PLACEHOLDERS[s["tipo"]]]
                    at = s["fin"]
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    return docs.join(spans, F.col(id_col) == F.col("__doc"), "left").withColumn(out_col, replace(F.col(text_col), F.col("__spans"))).drop("__doc", "__spans")
