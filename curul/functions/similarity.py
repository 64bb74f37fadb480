"""Similarities of texts: set measures in the JVM, sequence matching as a vectorised UDF."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from curul.functions.unicode_text import UNSTABLE, canonical

# Words that titles share without meaning.
TITLE_STOP = tuple("de la el los las del por que se en y a al con para un una su sus sobre lo como es o".split())


def title_words(c: Column) -> Column:
    """Distinct folded words of more than two letters that aren't stop words."""
    from curul.functions.text import words

    return F.filter(words(c), lambda w: (F.length(w) > 2) & ~w.isin(*TITLE_STOP))


def stems(c: Column, length: int = 6, stop: tuple[str, ...] = TITLE_STOP) -> Column:
    """Distinct beginnings of the folded words, one-letter words left out unless they are digits, and stop words."""
    from curul.functions.text import words

    long = lambda w: (F.length(w) > 1) | w.rlike(r"^\d$")
    kept = F.filter(words(c), lambda w: long(w) & ~w.isin(*stop) if stop else long(w))
    return F.array_distinct(F.transform(kept, lambda w: F.substring(w, 1, length)))


def jaccard(a: Column, b: Column) -> Column:
    """Common over united; 0 when both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def dice(a: Column, b: Column) -> Column:
    """Twice the common over the sum of sizes; 0 when both are empty."""
    return F.coalesce(F.try_divide(2 * F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)), F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Common over the smaller; 0 when either is empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))), F.lit(0.0))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts; 0 when either is null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)])


def token_set_of(x: str | None, y: str | None) -> float:
    """0 to 100: the best ratio among the common words and the common words with either rest."""
    s, t = set((x or "").split()), set((y or "").split())
    if not s or not t:
        return 0.0
    both = " ".join(sorted(s & t))
    left, right = (" ".join(filter(None, [both, " ".join(sorted(d))])) for d in (s - t, t - s))
    if both and both in (left, right):
        return 100.0
    return 100 * max(difflib.SequenceMatcher(None, p, q).ratio() for p, q in ((both, left), (both, right), (left, right)))


def partial_of(x: str | None, y: str | None) -> float:
    """0 to 100: the best ratio of the shorter text with a stretch of its length in the longer."""
    if not x or not y:
        return 0.0
    s, t = sorted((x, y), key=len)
    if s in t:
        return 100.0
    best = 0.0
    for i, j, _ in difflib.SequenceMatcher(None, s, t, autojunk=False).get_matching_blocks():
        k = max(0, j - i)
        best = max(best, difflib.SequenceMatcher(None, s, t[k : k + len(s)], autojunk=False).ratio())
    return 100 * best


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``token_set_of`` of two columns."""
    return pd.Series([token_set_of(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """``partial_of`` of two columns."""
    return pd.Series([partial_of(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: canonical(x)[0])


def canonical_form(c: Column) -> Column:
    """The text in one consistent form of its characters; only texts that fail the quick-check are rewritten in Python."""
    return F.coalesce(_canonical(F.when(c.rlike(UNSTABLE), c)), c)


def title_similarity(a: Column, b: Column) -> Column:
    """The largest of sequence ratio, word Jaccard and nine tenths of word containment; 0 when either text is empty."""
    from curul.functions.cleaning import alnum_words

    x, y = alnum_words(a), alnum_words(b)
    wa, wb = title_words(a), title_words(b)
    return F.when((F.coalesce(x, F.lit("")) == "") | (F.coalesce(y, F.lit("")) == ""), 0.0).otherwise(F.greatest(sequence_ratio(x, y), jaccard(wa, wb), 0.9 * containment(wa, wb)))
