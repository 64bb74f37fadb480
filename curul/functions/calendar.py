"""Dates, times of day and the legislative calendar, as expressions that stay in the JVM.

A value that can't be read gives null, never an error and never a text in place of a date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curul.functions.text import fold

# Names of the months.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
#: A term of three years began in this one.
TERM_BASE = 2024


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.try_to_date(F.concat_ws("-", y, m, d), "y-M-d"))


def _got(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def date_of_slashes(c: Column | str) -> Column:
    """d/m/yy or d/m/yyyy. Two-digit years from 69 on belong to the twentieth century."""
    t = F.trim(_col(c))
    p = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
    y = _got(t, p, 3).cast("int")
    return _date(F.when(y >= 100, y).when(y >= 69, y + 1900).otherwise(y + 2000), _got(t, p, 2), _got(t, p, 1))


def date_of_iso(c: Column | str) -> Column:
    """yyyy-mm-dd, also before a time of day."""
    t = F.trim(_col(c))
    p = r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:[T ].*)?$"
    return _date(_got(t, p, 1), _got(t, p, 2), _got(t, p, 3))


def date_of_prose(c: Column | str) -> Column:
    """"14 de mayo de 2024", "14 de mayo 2024", "14 de mayo del 2024", anywhere in the text."""
    t = fold(_col(c))
    p = r"(\d{1,2})\s+de\s+([a-z]+)(?:\s+del?)?\s+(\d{4})"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), _got(t, p, 2))
    return _date(_got(t, p, 3), F.nullif(month, F.lit(0)), _got(t, p, 1))


def date_of_serial(c: Column | str) -> Column:
    """A spreadsheet's day number between 20000 and 80000."""
    n = _got(F.trim(_col(c)), r"^(\d{5})(?:\.0+)?$", 1).cast("int")
    return F.when(n.between(20000, 80000), F.date_add(F.lit("1899-12-30").cast("date"), n))


def date_of_words(c: Column | str) -> Column:
    """"el [lunes] catorce de mayo de dos mil veinticuatro", or "de mil novecientos noventa y dos", anywhere in the text."""
    from curul.functions.numbers_es import number_of

    t = F.regexp_replace(fold(_col(c)), r"\s+", " ")
    p = r"\bel (?:(?:lunes|martes|mierc\w*|jueves|viernes|sabado|domingo),? )?([a-z]+(?: y [a-z]+)?) de ([a-z]+) (?:de|del ano) (dos mil|mil novecientos) ([a-z]+(?: y [a-z]+)?)"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), _got(t, p, 2))
    day = F.when(_got(t, p, 1) == "primero", 1).otherwise(number_of(_got(t, p, 1)))
    century = F.when(_got(t, p, 3) == "dos mil", 2000).otherwise(1900)
    # a word after the year's own, as in "veinticuatro a las", isn't part of it
    year = F.coalesce(number_of(_got(t, p, 4)), number_of(F.substring_index(_got(t, p, 4), " ", 1)))
    return _date(century + year, F.nullif(month, F.lit(0)), day)


def any_date(c: Column | str) -> Column:
    """The first form that reads: ISO, slashes, prose, spreadsheet number."""
    return F.coalesce(date_of_iso(c), date_of_slashes(c), date_of_prose(c), date_of_serial(c))


def prose_date(c: Column | str) -> Column:
    """14 de mayo de 2024."""
    d = _col(c)
    return F.concat(F.dayofmonth(d).cast("string"), F.lit(" de "), F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d)), F.lit(" de "), F.year(d).cast("string"))


def words_date(c: Column | str) -> Column:
    """el catorce de mayo de dos mil veinticuatro; null before 1900 and after 2099."""
    from curul.functions.numbers_es import words_of

    d = _col(c)
    century = F.when(F.year(d).between(1900, 1999), "mil novecientos").when(F.year(d).between(2000, 2099), "dos mil")
    rest = F.pmod(F.year(d), F.lit(100))
    year = F.when(rest == 0, century).otherwise(F.concat(century, F.lit(" "), words_of(rest)))
    return F.concat(F.lit("el "), words_of(F.dayofmonth(d)), F.lit(" de "), F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d)), F.lit(" de "), year)


def format_date(c: Column | str, form: str) -> Column:
    """prose (14 de mayo de 2024), slashes (14/05/24), slashes4 (14/05/2024), dots (14.5.24) or iso."""
    d = _col(c)
    return {"prose": lambda: prose_date(d), "slashes": lambda: F.date_format(d, "dd/MM/yy"), "slashes4": lambda: F.date_format(d, "dd/MM/yyyy"), "dots": lambda: F.date_format(d, "d.M.yy"), "iso": lambda: F.date_format(d, "yyyy-MM-dd")}[form]()


def period_title(c: Column | str) -> Column:
    """The heading of the period or recess a day falls in, as "Segundo Periodo Ordinario" or "Primer Receso"."""
    s = period_or_recess(c)
    nth = F.element_at(F.array(F.lit("Primer"), F.lit("Segundo"), F.lit("Tercer")), s["number"])
    return F.concat(nth, F.when(s["kind"] == "periodo", " Periodo Ordinario").otherwise(" Receso"))


def _month_day(c: Column | str) -> Column:
    return F.month(_col(c)) * 100 + F.dayofmonth(_col(c))


def period(c: Column | str) -> Column:
    """Legislative period 1, 2 or 3 with the recess after it: from 15 September, 15 January, 15 May."""
    md = _month_day(c)
    return F.when((md >= 915) | (md <= 114), 1).when(md <= 514, 2).when(md <= 914, 3)


def period_or_recess(c: Column | str) -> Column:
    """(kind, number): periods end on 15 December, 15 March and 15 July; the rest is recess."""
    md = _month_day(c)
    kind = F.when(md.between(915, 1215) | md.between(115, 315) | md.between(515, 715), "periodo").when(md.isNotNull(), "receso")
    return F.struct(kind.alias("kind"), period(c).alias("number"))


def cycle_year(c: Column | str) -> Column:
    """The year in which the legislative year began: it turns on 15 September."""
    d = _col(c)
    return F.year(d) - F.when(_month_day(d) >= 915, 0).otherwise(1)


def term_start(c: Column | str, base: int = TERM_BASE) -> Column:
    """The year in which the three-year term began."""
    y = cycle_year(c)
    return y - F.pmod(y - F.lit(base), F.lit(3))


def legislative_year(c: Column | str, base: int = TERM_BASE) -> Column:
    """1, 2 or 3 within the term."""
    return F.pmod(cycle_year(c) - F.lit(base), F.lit(3)) + 1


def year_label(c: Column | str, since: str, none: str = "N/A") -> Column:
    """Primero, Segundo or Tercero counted from a fixed day; ``none`` outside the three years."""
    months = F.months_between(_col(c), F.lit(since).cast("date"))
    return F.when((months >= 0) & (months < 12), "Primero").when((months >= 12) & (months < 24), "Segundo").when((months >= 24) & (months < 36), "Tercero").otherwise(none)


def seconds_of_day(c: Column | str) -> Column:
    """hh:mm[:ss], with a.m. or p.m.; hours of 24 and more are no time of day."""
    t = fold(F.trim(_col(c)))
    p = r"^(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(?:([ap])\.?\s*m\.?)?(?:\s*h(?:oras|rs|s)?\.?)?$"
    h, m, s, half = _got(t, p, 1).cast("int"), _got(t, p, 2).cast("int"), F.coalesce(_got(t, p, 3).cast("int"), F.lit(0)), _got(t, p, 4)
    hour = F.when(half == "p", F.pmod(h, F.lit(12)) + 12).when(half == "a", F.pmod(h, F.lit(12))).otherwise(h)
    return F.when((hour < 24) & (m < 60) & (s < 60), hour * 3600 + m * 60 + s)


def seconds_of_duration(c: Column | str) -> Column:
    """[h]h:mm[:ss] of any number of hours."""
    t = F.trim(_col(c))
    p = r"^(\d+):(\d{2})(?::(\d{2}))?$"
    return _got(t, p, 1).cast("int") * 3600 + _got(t, p, 2).cast("int") * 60 + F.coalesce(_got(t, p, 3).cast("int"), F.lit(0))


def delay_seconds(called: Column | str, begun: Column | str) -> Column:
    """Begun minus called; negative when it began early."""
    return _col(begun) - _col(called)


def delay_minutes(called: Column | str, begun: Column | str) -> Column:
    """Whole minutes, rounded towards the past."""
    return F.floor(delay_seconds(called, begun) / 60)


def called_or_estimated(called: Column | str, begun: Column | str) -> Column:
    """(called, estimated, note): the time called for; where it isn't known, the full hour in which it began."""
    c, b = _col(called), _col(begun)
    return F.struct(
        F.coalesce(c, F.floor(b / 3600).cast("int") * 3600).alias("called"), (c.isNull() & b.isNotNull()).alias("estimated"),
        F.when(c.isNull() & b.isNotNull(), "La hora de cita es una estimación").when(c.isNull(), "Hora de cita no disponible").alias("note"),
    )


def duration_seconds(begun: Column | str, ended: Column | str, past_midnight: bool = True) -> Column:
    """Ended minus begun; past midnight it goes on into the next day unless told otherwise."""
    d = _col(ended) - _col(begun)
    return F.pmod(d, F.lit(86400)) if past_midnight else d


def clock(c: Column | str, hours: int = 24) -> Column:
    """Seconds of the day as HH:MM:SS, or hh:mm:ss a.m./p.m."""
    s = _col(c).cast("int")
    h, m, x = F.floor(s / 3600).cast("int"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("int"), F.pmod(s, F.lit(60))
    if hours == 24:
        return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", h, m, x))
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d %s", F.pmod(h - 1, F.lit(12)) + 1, m, x, F.when(h < 12, "a.m.").otherwise("p.m.")))


def span(c: Column | str, signed: bool = False) -> Column:
    """Seconds as H:MM:SS of any number of hours; with ``signed`` a minus before negative ones, else they give null."""
    s = F.abs(_col(c)).cast("bigint")
    t = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    return F.when(_col(c) >= 0, t).when((_col(c) < 0) & F.lit(signed), F.concat(F.lit("-"), t))
