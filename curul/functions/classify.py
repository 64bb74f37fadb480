"""Ordered classifiers: the first rule that matches wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curul.functions.text import fold

# Words that mark a vote's text as an initiative, and as an agreement; looked for anywhere in the text.
INITIATIVE_WORDS = "dictamen reforma decreto proposicion propuesta propuesto expide expedir expedicion".split()
AGREEMENT_WORDS = "acuerdo acordar acuerdan exhorto exhorta eleccion elegir eligen votacion votaciones votar votan voto designacion designa oficio aprobacion aprobar aprueba aprobado habilita".split()
# Kinds of sessions in the order in which they are looked for.
SESSION_KINDS = (("comision permanente", "Comisión Permanente"), ("solemne", "Solemne"), ("extraordinaria", "Extraordinaria"), ("previa", "Previa"), ("ordinaria", "Ordinaria"))
# Codes of attendance.
ATTENDANCE_CODES = {"asistencia": 1, "retardo justificado": 2, "retardo injustificado": 3, "inasistencia justificada": 4, "inasistencia injustificada": 5, "con licencia": 6, "sin informacion": 7, "fallecimiento": 8}
# Codes of votes in sheets.
VOTE_CODES = {"favor": 1, "contra": 2, "abstencion": 3, "na": 0, "secreta": 4}
# Texts in the errors of services, by kind, in the order in which they are looked for.
ERROR_RULES = (
    ("cuota_diaria_agotada", r"(?s)(?=.*(?:\b429\b|resource_exhausted|quota))(?=.*per ?day)"),
    ("credenciales_invalidas", r"api key not valid|api_key_invalid|api key expired|permission_denied|unauthenticated"),
    ("cuota_agotada", r"\b429\b|resource_exhausted|quota"),
    ("alta_demanda", r"\b(?:500|502|503|504)\b|unavailable|overloaded|internal|deadline_exceeded"),
    ("error_red", r"connect|timeout|timed out|name resolution|network|ssl"),
    ("respuesta_invalida", r"json|expecting value|extra data|unterminated|expecting property"),
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered(text: Column, rules: tuple[tuple[str, str], ...], otherwise: Column | None = None) -> Column:
    """The label of the first (label, pattern) found in the text."""
    out = None
    for label, pattern in rules:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.otherwise(otherwise) if otherwise is not None else out


def keyword_class(c: Column | str, first: list[str] = INITIATIVE_WORDS, second: list[str] = AGREEMENT_WORDS) -> Column:
    """1 when any word of the first list is part of the folded text, else 2 for the second, else 0; null stays null."""
    t = fold(_col(c))
    return F.when(t.isNull(), None).when(t.rlike("|".join(first)), 1).when(t.rlike("|".join(second)), 2).otherwise(0)


def session_kind(c: Column | str) -> Column:
    """The kind of session its text names, else the trimmed text; null stays null."""
    t = fold(_col(c))
    return ordered(t, tuple((label, part) for part, label in SESSION_KINDS), F.trim(_col(c)))


def session_kind_public(c: Column | str) -> Column:
    """As ``session_kind``, with the ordinary session called public and white space collapsed in what is none."""
    k = session_kind(c)
    return F.when(k == "Ordinaria", "Pública Ordinaria").otherwise(F.regexp_replace(k, r"\s+", " "))


def session_kind_key(c: Column | str) -> Column:
    """The kind as part of a key: folded, hyphens for spaces; desconocida where there is no text."""
    t = F.trim(F.regexp_replace(fold(F.coalesce(_col(c), F.lit(""))), r"\s+", " "))
    key = F.regexp_replace(ordered(t, tuple((part, part) for part, _ in SESSION_KINDS), t), " ", "-")
    return F.when(key == "", "desconocida").otherwise(key)


def tells_of_a_vote(c: Column | str) -> Column:
    """Whether a text is worth a costly reading for votes: it speaks of unanimity or of votes in favour."""
    return F.coalesce(_col(c).rlike(r"(?iu)unanimidad de votos|votos? a favor"), F.lit(False))


def attendance_code(c: Column | str) -> Column:
    """(code, raw): the code of the attendance word, and the text itself where it is none."""
    t = F.trim(fold(_col(c)))
    code = F.create_map(*[x for k, v in ATTENDANCE_CODES.items() for x in (F.lit(k), F.lit(v))])[t]
    return F.struct(code.alias("code"), F.when(code.isNull(), _col(c)).alias("raw"))


def vote_kind(vote: Column | str, attendance: Column | str | None = None) -> Column:
    """favor, contra, abstencion or unrecognised by what the folded vote holds; absent unless attendance says so."""
    t = fold(_col(vote))
    kind = F.when(t.contains("favor"), "favor").when(t.contains("contra"), "contra").when(t.contains("abstencion"), "abstencion").otherwise("no_reconocido")
    return kind if attendance is None else F.when(F.coalesce(F.trim(fold(_col(attendance))) != "asistencia", F.lit(True)), "ausente").otherwise(kind)


def error_kind(c: Column | str) -> Column:
    """The kind of failure an error text tells, after its last "Último error:"."""
    t = F.lower(F.regexp_replace(_col(c), r"(?s)^.*?Último error:", ""))
    return ordered(t, ERROR_RULES, F.lit("error_desconocido"))


def person_name_valid(c: Column | str, stop: tuple[str, ...] = ("sesion", "lista", "asistencia", "total", "presidencia", "secretaria", "orden")) -> Column:
    """Whether a text can be a person's name: at most 80 characters, letters only, 2 to 10 words, none of the stop words."""
    t = F.trim(_col(c))
    ws = F.split(F.regexp_replace(fold(t), r"\s+", " "), " ")
    return F.coalesce((F.length(t) <= 80) & t.rlike(r"^[\p{L}.' -]+$") & F.size(ws).between(2, 10) & ~F.arrays_overlap(ws, F.array(*[F.lit(w) for w in stop])), F.lit(False))


def detect_in_order(c: Column | str, patterns: list[tuple[str, str]]) -> Column:
    """Labels whose (pattern, label) occurs in the folded text, by first position."""
    t = fold(_col(c))
    found = F.array(*[F.struct(F.regexp_instr(t, F.lit(f"(?:{p})")).alias("at"), F.lit(label).alias("label")) for p, label in patterns])
    return F.transform(F.array_sort(F.filter(found, lambda x: x["at"] > 0)), lambda x: x["label"])


def role(c: Column | str) -> Column:
    """Presidencia, Secretaría or Vocal by how the folded text begins."""
    t = F.trim(fold(_col(c)))
    return F.when(t.startswith("presiden"), "Presidencia").when(t.startswith("secretari"), "Secretaría").otherwise("Vocal")


def contact_kind(c: Column | str) -> Column:
    """email, facebook, twitter, telefono or otro."""
    t = F.trim(F.lower(_col(c)))
    return F.when(t.isNull(), None).when(t.rlike(r"^[a-z0-9._+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+$"), "email").when(t.contains("facebook"), "facebook").when(t.rlike(r"twitter|x\.com|^@"), "twitter").when(t.rlike(r"^[+()0-9 .-]{7,}$"), "telefono").otherwise("otro")
