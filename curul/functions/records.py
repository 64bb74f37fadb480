"""Field-level expressions of records: defaults, codes, ratios, keys for sorting, splitting of people and studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curul.functions.classify import VOTE_CODES
from curul.functions.text import collapse_spaces, fold
from curul.functions.unicode_text import fold as fold_text

# Particles that stay in lower case in names and titles.
PARTICLES = ("de", "del", "la", "las", "los", "y", "e", "en", "a", "al", "con", "por", "para", "el", "que", "se", "o", "u")
# Degrees with their rank and how they show in a folded text, in the order in which they are tried.
DEGREES = (
    ("Doctorado", 6.0, r"\bdoctor(ado|a)?\b"), ("Maestría", 5.0, r"\bmaestr(ia|o|a)\b"), ("Postgrado", 4.0, r"\bpost?grado\b"), ("Especialidad", 3.0, r"\bespecialidad\b|\bespecializacion\b"),
    ("Licenciatura", 2.0, r"\blicenciatura\b|\blicenciad[oa]\b|^lic\b"), ("Ingeniería", 2.0, r"\bingenier(ia|o|a)\b"), ("Técnico Superior", 1.5, r"\btecnic[oa] superior\b|\btsu\b"), ("Bachillerato", 1.0, r"\bbachillerato\b|\bpreparatoria\b"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Exactly the named columns, each from the frame where it has a value, else its default."""
    return df.select(*[(F.coalesce(F.col(c), v) if c in df.columns else v).alias(c) for c, v in defaults.items()])


def column_kind(name: str, derived: tuple[str, ...] = (), numbers: tuple[str, ...] = ()) -> str:
    """derived, date, time, number or text, by a column's name."""
    n = fold_text(name)
    return "derived" if n in map(fold_text, derived) else "date" if n.startswith("fecha") else "time" if n.startswith("hora") else "number" if n in map(fold_text, numbers) else "text"


def any_line(text: Column | str, pattern: str, but_not: str | None = None) -> Column:
    """Whether some line of the folded text matches, and doesn't match what is ruled out; null texts give false."""
    lines = F.split(fold(_col(text)), "\n")
    ok = lambda x: x.rlike(pattern) if but_not is None else x.rlike(pattern) & ~x.rlike(but_not)
    return F.coalesce(F.exists(lines, ok), F.lit(False))


def laws_compatible(a: Column, b: Column, item_without_law: Column) -> Column:
    """Known laws must hold one another; a law against an item that has none isn't compatible; unknown ones are."""
    x, y = fold(a), fold(b)
    return F.when(x.isNotNull() & y.isNotNull(), x.contains(y) | y.contains(x)).when(x.isNotNull() & item_without_law, False).otherwise(True)


def distinct_folded(items: Column) -> Column:
    """An array's texts, each once whatever its case and accents, the first form kept, in order."""
    keys = F.transform(items, lambda x: fold(x))
    return F.filter(items, lambda x, i: F.array_position(keys, fold(x)) == i + 1)


def percent(done: Column, planned: Column) -> Column:
    """100 done / planned; null over nothing. Round only where it is shown."""
    return F.try_divide(100.0 * done, planned)


def absences(f: Column, c: Column, a: Column, total: Column | None = None, members: int = 41) -> Column:
    """Total (the number of members by default) less the votes cast; negative when more were counted than there are."""
    return (F.lit(members) if total is None else F.coalesce(total, F.lit(members))) - (F.coalesce(f, F.lit(0)) + F.coalesce(c, F.lit(0)) + F.coalesce(a, F.lit(0)))


def vote_code(vote: Column, secret: Column) -> Column:
    """The code of a vote in sheets: exact words only, unknown ones 0; every vote of a secret ballot has the secret code."""
    table = F.create_map(*[x for k, v in VOTE_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.when(secret, VOTE_CODES["secreta"]).otherwise(F.coalesce(table[F.trim(fold(vote))], F.lit(0)))


def mixed_key(number: Column, last: str = "AG") -> Column:
    """Sort key of numbers as text: the number, the closing word after all, others before all."""
    return F.when(F.trim(number) == last, 1_000_000).otherwise(F.coalesce(F.trim(number).try_cast("int"), F.lit(-1)))


def surname_key(name: Column | str) -> Column:
    """Sorts by surnames, then given names: "Given Given Surname Surname" or "Surname Surname, Given". ñ comes after n,
    particles stay with the word after them, titles are left out. Other languages' order rules play no part."""
    t = collapse_spaces(F.regexp_replace(F.lower(_col(name)), r"^(?:c|lic|dr|dra|ing|dip|diputad[oa])\.?\s+", ""))
    joined = F.regexp_replace(F.regexp_replace(t, r"\bde (la|las|los) ", "de_$1_"), r"\b(del?) ", "$1_")
    w = F.split(joined, " ")
    turned = F.when(t.contains(","), F.regexp_replace(t, r"\s*,\s*", "|")).otherwise(
        F.concat(F.array_join(F.slice(w, F.greatest(F.size(w) - 1, F.lit(1)), 2), " "), F.lit("|"), F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), " "))
    )
    return F.translate(F.regexp_replace(turned, "ñ", "n￿"), "áéíóúü_", "aeiouu ")


def title_case(text: Column | str, particles: tuple[str, ...] = PARTICLES) -> Column:
    """Each word with a capital, particles in lower case unless they begin the text."""
    w = F.split(collapse_spaces(F.lower(_col(text))), " ")
    return F.array_join(F.transform(w, lambda x, i: F.when((i > 0) & x.isin(*particles), x).otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 10_000)))), " ")


def degree(text: Column | str) -> Column:
    """(degree, rank) that a text names, by the first rule that matches; null where none does."""
    t = F.trim(fold(_col(text)))
    out = None
    for name, rank, pattern in DEGREES:
        s = F.struct(F.lit(name).alias("degree"), F.lit(rank).alias("rank"))
        out = F.when(t.rlike(pattern), s) if out is None else out.when(t.rlike(pattern), s)
    return out


def study(text: Column | str) -> Column:
    """(degree, rank, field, institution) of a line as "Licenciatura en Derecho por la Universidad X"; parts that aren't
    there are null."""
    t = collapse_spaces(_col(text))
    place = r"(?iu)(?:\s*[,:;–—-]\s*|\s+(?:cursad[oa]s?\s+)?(?:(?:en|por|de|con)\s+(?:la\s+|el\s+)?)?)((?:universidad|instituto|escuela|centro\s+universitario|colegio|facultad|tecnol[óo]gico|academia|polit[ée]cnic[oa])\b.*)$"
    institution = F.nullif(F.regexp_extract(t, place, 1), F.lit(""))
    rest = F.regexp_replace(t, place, "")
    field = F.nullif(F.trim(F.regexp_extract(rest, r"(?iu)^\S+(?:\s+superior)?\s+(?:en|de)\s+(.+)$", 1)), F.lit(""))
    d = degree(rest)
    return F.struct(d["degree"].alias("degree"), d["rank"].alias("rank"), field.alias("field"), institution.alias("institution"))


def phone_form(text: Column | str) -> Column:
    """Ten digits as 123 456 7890, country and trunk prefixes left out; null where there aren't ten digits."""
    n = F.regexp_replace(F.regexp_replace(_col(text), r"(?i)\s*ext\..*$", ""), r"\D", "")
    ten = F.regexp_extract(n, r"^(?:0052|52)?1?(\d{10})$|^01(\d{10})$", 1)
    ten = F.when(ten == "", F.regexp_extract(n, r"^01(\d{10})$", 1)).otherwise(ten)
    return F.when(ten != "", F.concat_ws(" ", F.substring(ten, 1, 3), F.substring(ten, 4, 3), F.substring(ten, 7, 4)))


def people(text: Column | str) -> Column:
    """Names in "A, B y C", those of at least two words; null gives an empty array."""
    return F.coalesce(F.filter(F.transform(F.split(_col(text), r"\s*[,;]\s*|\s+y\s+"), lambda x: F.trim(x)), lambda x: F.size(F.split(x, r"\s+")) >= 2), F.array().cast("array<string>"))


def first_attachment(links: Column, kind: str) -> Column:
    """Of an array of (href, text): the first link to a PDF whose folded label holds the kind; documents of text programs
    don't count."""
    ok = F.filter(links, lambda x: fold(x["text"]).contains(kind) & F.lower(x["href"]).contains(".pdf") & ~F.lower(x["text"]).rlike(r"\.docx?\b"))
    return F.get(ok, F.lit(0))["href"]


def document_id(url: Column) -> Column:
    """The number in "acta_123" or "?id=123"; null where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"acta_(\d+)", 1), F.lit("")), F.nullif(F.regexp_extract(url, r"[?&]id=(\d+)", 1), F.lit("")))


def topic_of(committees: Column, topics: dict[str, int], beginnings: dict[str, int] | None = None) -> Column:
    """The topic of the first committee in an array that the table knows, folded, without "comision de"; else null.
    ``beginnings`` are topics of committees that begin so, for those that the table lacks."""
    table = F.create_map(*[x for k, v in topics.items() for x in (F.lit(fold_text(k)), F.lit(v))])

    def one(c: Column) -> Column:
        k = F.trim(F.regexp_replace(fold(c), r"^(?:comision|comite) (?:de )?(?:la |las |los )?", ""))
        return F.coalesce(table[k], *[F.when(k.startswith(fold_text(b)), v) for b, v in (beginnings or {}).items()])

    known = F.filter(F.transform(committees, one), lambda t: t.isNotNull())
    return F.get(known, F.lit(0))


def backoff_seconds(attempt: Column, base: float = 5.0, most: float | None = None) -> Column:
    """base, 2 base, 4 base, ... for attempts 1, 2, 3, ...; never over ``most``."""
    wait = F.lit(base) * F.pow(F.lit(2.0), attempt - 1)
    return wait if most is None else F.least(wait, F.lit(most))


def retry_delay(error: Column | str, otherwise: float = 5.0, most: float = 10.0) -> Column:
    """Seconds to wait that an error text asks for, as "retryDelay: '7s'" or "retry in 7.5s", at most ``most``."""
    said = F.coalesce(F.nullif(F.regexp_extract(_col(error), r"(?i)retryDelay['\"]?\s*:\s*['\"]?(\d+(?:\.\d+)?)s", 1), F.lit("")), F.nullif(F.regexp_extract(_col(error), r"(?i)retry in (\d+(?:\.\d+)?)s", 1), F.lit("")))
    return F.least(F.coalesce(said.cast("double"), F.lit(otherwise)), F.lit(most))


def guarded(rows: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which all required texts are there and not blank; rows without any value are left out with them."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    return rows.where(ok).dropna(how="all")


def split_by(rows: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the predicate, and the others; one that is null counts as not met."""
    p = F.coalesce(predicate, F.lit(False))
    return rows.where(p), rows.where(~p)


def is_one_of(c: Column | str, values: tuple[str, ...]) -> Column:
    """Whether a folded, trimmed value is one of the given ones; null is none."""
    return F.coalesce(F.trim(fold(_col(c))).isin(*map(fold_text, values)), F.lit(False))


def sentence_case(text: Column | str, proper: tuple[str, ...] = ()) -> Column:
    """Lower case with a capital at the beginning; the proper names given keep their form wherever they occur."""
    t = collapse_spaces(F.lower(_col(text)))
    t = F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1_000_000))
    for name in sorted(proper, key=lambda x: (-len(x), x)):
        t = F.replace(t, F.lit(name.lower()), F.lit(name))
    return t


# Words in the names of presenters that aren't persons, by part of a word.
_OFFICES = "titular comisi junta camara presidente ayuntamiento congreso municipal coordinador fiscal tribunal auditor poder secretar".split()


def short_presenter(name: Column | str) -> Column:
    """A person's first name; offices and bodies in full."""
    t = F.trim(_col(name))
    return F.when(fold(t).rlike("|".join(_OFFICES)), t).otherwise(F.substring_index(t, " ", 1))


def joined_note(items: Column, head: str = "Concentrada: ") -> Column:
    """From an array of (day, presenter): "Concentrada: 10.3.22 Mónica, 20.10.22 Karla y 10.4.25 Ana", by day; null where
    there are fewer than two."""
    from curul.functions.cleaning import join_with_y

    parts = F.transform(F.array_sort(items), lambda x: F.concat_ws(" ", F.date_format(x["day"], "d.M.yy"), short_presenter(x["presenter"])))
    return F.when(F.size(items) > 1, F.concat(F.lit(head), join_with_y(parts)))


def unique_names(names: DataFrame, name: str, order: str, most: int = 31) -> DataFrame:
    """Adds ``sheet``: the safe name, with " (2)", " (3)" ... where an earlier row has it; never over ``most`` characters."""
    from curul.functions.cleaning import safe_name

    n = F.row_number().over(Window.partitionBy("__safe").orderBy(order))
    mark = F.when(F.col("__n") == 1, "").otherwise(F.concat(F.lit(" ("), F.col("__n"), F.lit(")")))
    r = names.withColumn("__safe", safe_name(F.col(name), most)).withColumn("__n", n).withColumn("__mark", mark)
    return r.withColumn("sheet", F.concat(F.expr(f"left(`__safe`, {most} - length(`__mark`))"), "__mark")).drop("__safe", "__n", "__mark")


def cell_text(c: Column | str, df_type: str = "") -> Column:
    """A nested value as JSON text."""
    return F.to_json(_col(c))
