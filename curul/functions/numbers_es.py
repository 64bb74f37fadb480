"""Spanish number words as expressions over a fixed table of the numbers 0 to 99, built by rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curul.functions.text import fold

# Spanish number words.
UNITS = "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciseis diecisiete dieciocho diecinueve veinte veintiuno veintidos veintitres veinticuatro veinticinco veintiseis veintisiete veintiocho veintinueve".split()
TENS = "treinta cuarenta cincuenta sesenta setenta ochenta noventa".split()
HUNDREDS = "cien doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos".split()
WORDS = [*UNITS, *[t if not u else f"{t} y {UNITS[u]}" for t in TENS for u in range(10)]]
#: Shortened forms before a noun, and the feminine.
SHORT = {"un": 1, "una": 1, "veintiun": 21, "veintiuna": 21, **{f"{t} y {u}": 31 + 10 * k for k, t in enumerate(TENS) for u in ("un", "una")}}


def words_of(number: Column) -> Column:
    """The words of 0 to 999; null beyond."""
    n = number.cast("int")
    small, hundred = F.array(*[F.lit(w) for w in WORDS]), F.array(*[F.lit(w) for w in ["ciento", *HUNDREDS[1:]]])
    rest = F.pmod(n, F.lit(100))
    big = F.when(n == 100, "cien").when(rest == 0, F.get(hundred, n / 100 - 1)).otherwise(F.concat_ws(" ", F.get(hundred, F.floor(n / 100).cast("int") - 1), F.get(small, rest)))
    return F.when(n.between(0, 99), F.get(small, n)).when(n.between(100, 999), big)


def number_of(phrase: Column) -> Column:
    """The number that words or digits say, case and accents aside; null when they say none or more than 999.

    The phrase is folded once and looked up in a table of a hundred numbers, after its word for hundreds if it has one."""
    table = F.create_map(*[x for w, n in [*((w, n) for n, w in enumerate(WORDS)), *SHORT.items()] for x in (F.lit(w), F.lit(n))])
    hundreds = F.create_map(*[x for k, w in enumerate([*HUNDREDS, "ciento"]) for x in (F.lit(w), F.lit(100 * (k + 1) if w != "ciento" else 100))])

    def read(t: Column) -> Column:
        tail = F.nullif(F.regexp_replace(t, r"^\w+ ?", ""), F.lit(""))
        big = hundreds[F.substring_index(t, " ", 1)]
        return F.when(t.rlike(r"^\d{1,9}$"), t.try_cast("int")).otherwise(F.coalesce(table[t], F.when(tail.isNull(), big).otherwise(big + table[tail])))

    # inside a function over an array the folded text is made once, not once a use
    t = F.trim(F.regexp_replace(fold(phrase), r"[^a-z0-9]+", " "))
    return F.element_at(F.transform(F.array(t), read), 1)
