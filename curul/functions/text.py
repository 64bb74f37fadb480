"""Text expressions that stay in the JVM (whole-stage codegen where Spark has it)."""

from __future__ import annotations

import unicodedata as ud

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and their base letter, by rule: one base letter plus combining marks.
_PAIRS = [(c, d[0]) for c in map(chr, range(0xC0, 0x250)) if (d := ud.normalize("NFD", c)) != c and len(ud.normalize("NFC", d)) == 1]
ACCENTED, UNACCENTED = "".join(a for a, _ in _PAIRS), "".join(b for _, b in _PAIRS)


def strip_accents(c: Column | str) -> Column:
    """Without combining marks, whether separate or part of the letter; ñ becomes n. Null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(c, ACCENTED, UNACCENTED), r"\p{M}+", "")


def fold(c: Column | str) -> Column:
    """Lower case without accents."""
    c = F.col(c) if isinstance(c, str) else c
    return strip_accents(F.lower(c))


def words(c: Column | str) -> Column:
    """Distinct runs of letters and digits of the folded text; null gives an empty array."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract_all(fold(c), F.lit(r"([\p{L}\p{Nd}]+)"), F.lit(1))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def collapse_spaces(c: Column | str) -> Column:
    """Every run of white space as one space, ends trimmed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
