"""Cleaning, null words, typed conversion and small text shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curul.functions.calendar import any_date, seconds_of_day
from curul.functions.text import collapse_spaces, fold

#: Words for a missing value, as a default; every call may name its own.
NULL_WORDS = ("", "-", "--", "n/a", "n.a.", "n/d", "s/d", "null", "none", "nan", "sin información", "sin informacion")
# What title pages and footers of gazettes repeat, besides the name of the state.
_COVER = (r"H\. CONGRESO DEL ESTADO", r"Secretaría General", r"[A-Z]*TADOS UNIDOS MEXICA[A-Z]*", r"Marzo\.\s*Mes\s+de\s+las\s+Mujeres", r"Av\.\s+32\s+Oriente.*?72290", r"www\.congreso\w*\.gob\.mx")
_PAGE = r"--- PAGE \d+ ---"
#: Footers and page marks of gazettes.
PAGE_NOISE = (r"(?i)--- page \d+ ---", r"(?i)\n?Pag\. *\d+\n?")


def null_words(c: Column | str, words: tuple[str, ...] = NULL_WORDS) -> Column:
    """Null when the trimmed value is one of the words, whatever its case; else unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.lower(F.trim(c)).isin(*words), c)


def cover_noise(state: str = "PUEBLA", lined: bool = False) -> tuple[str, ...]:
    """The patterns of title pages and footers. On one line the state's name goes however it is spaced, and the heading
    ACTA; with lines kept, only the name in spaced letters, and page marks."""
    any_case = lambda p: f"(?iu){p}"
    name = (r"\s+" if lined else r"\s*").join(state)
    return tuple(map(any_case, (_PAGE, _COVER[0], name, *_COVER[1:], r"Pag\.\s*\d+" if lined else "ACTA")))


def without(c: Column | str, patterns: tuple[str, ...] = PAGE_NOISE, by: str = " ") -> Column:
    """Every match of each pattern, in order, replaced."""
    c = F.col(c) if isinstance(c, str) else c
    for p in patterns:
        c = F.regexp_replace(c, p, by)
    return c


def flat_text(c: Column | str, patterns: tuple[str, ...] = PAGE_NOISE) -> Column:
    """Without noise, on one line."""
    return collapse_spaces(without(c, patterns))


def lined_text(c: Column | str, patterns: tuple[str, ...] = PAGE_NOISE, by: str = "\n") -> Column:
    """Without noise, lines kept, at most one empty line in a row."""
    t = F.regexp_replace(without(c, patterns, by), r"[ \t]+", " ")
    return F.regexp_replace(t, r"\n{3,}", "\n\n")


def alnum_words(c: Column | str) -> Column:
    """Folded, everything but letters and digits as single spaces."""
    return F.trim(F.regexp_replace(fold(c), r"[^a-z0-9]+", " "))


def convert(c: Column | str, kind: str, words: tuple[str, ...] = NULL_WORDS) -> Column:
    """(value, status): the text brought to the kind (date, time, number or text), status ok, empty or invalid.

    An invalid value keeps its text in ``raw`` so nothing is lost."""
    c = F.col(c) if isinstance(c, str) else c
    known = null_words(c, words)
    value = {"date": lambda: any_date(known).cast("string"), "time": lambda: seconds_of_day(known).cast("string"), "number": lambda: F.trim(known).try_cast("double").cast("string"), "text": lambda: known}[kind]()
    status = F.when(known.isNull(), "empty").when(value.isNotNull(), "ok").otherwise("invalid")
    return F.struct(value.alias("value"), status.alias("status"), c.alias("raw"))


def sniff_columns(df: DataFrame, columns: list[str], words: tuple[str, ...] = NULL_WORDS) -> DataFrame:
    """(column, kind, known): the narrowest of date, time, number and text that all known values read as.

    One aggregate pass over all columns' values, one below the other; a column without known values is empty."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")) for c in columns])
    v = df.select(F.explode(values).alias("x")).select("x.column", null_words("x.text", words).alias("v")).where("v IS NOT NULL")
    read = v.select("column", any_date("v").isNotNull().alias("date"), seconds_of_day("v").isNotNull().alias("time"), F.trim("v").try_cast("double").isNotNull().alias("number"))
    kinds = read.groupBy("column").agg(*[F.bool_and(k).alias(k) for k in ("date", "time", "number")], F.count("*").alias("known"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    kind = F.when(F.col("known").isNull(), "empty").when(F.col("date"), "date").when(F.col("time"), "time").when(F.col("number"), "number").otherwise("text")
    return names.join(kinds, "column", "left").select("column", kind.alias("kind"), F.coalesce("known", F.lit(0)).cast("bigint").alias("known"))


def rename_by_key(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns renamed where their folded name, less everything but letters and digits, is one of the keys."""
    from curul.functions.unicode_text import fold as fold_text

    key = lambda s: "".join(ch for ch in fold_text(s) if ch.isalnum())
    to = {key(k): v for k, v in names.items()}
    return df.select(*[F.col(f"`{c}`").alias(to.get(key(c), c)) for c in df.columns])


def without_private(df: DataFrame) -> DataFrame:
    """Without columns whose name begins with an underscore."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def join_with_y(items: Column) -> Column:
    """An array as "a, b y c"; empty gives an empty text."""
    n = F.size(items)
    return F.when(n <= 0, "").when(n == 1, F.element_at(items, 1)).otherwise(F.concat(F.array_join(F.slice(items, 1, F.greatest(n - 1, F.lit(1))), ", "), F.lit(" y "), F.element_at(items, -1)))


def short_key(c: Column | str, length: int = 16) -> Column:
    """The first letters of the MD5 of the normalised text."""
    return F.substring(F.md5(alnum_words(c)), 1, length)


def safe_name(c: Column | str, most: int = 31) -> Column:
    """A sheet name: without characters that sheets forbid, cut, never empty."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.substring(F.trim(F.regexp_replace(F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""), r"[\[\]:*?/\\]", " ")), 1, most)
    return F.when(F.coalesce(t, F.lit("")) == "", "Sin tipo").otherwise(t)
