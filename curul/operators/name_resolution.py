"""Resolving typed person names to a roster of official names by equi-joins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.functions.lexicon import Trie
from curul.functions.names import given_readings, is_body, person_cost, person_words
from curul.functions.unicode_text import fold, is_missing
from curul.plans.spread import spread
from curul.plans.state import cut

#: Distinct words of official names; names draw on a closed stock, and more than this raises before anything is sent.
MOST_WORDS = 200_000
#: Largest total edit cost between a typed name and the official one.
MOST_COST = 5.0


def word_radius(w: str) -> int:
    """Edits tolerated in one word of a name."""
    return 0 if len(w) < 3 else 1 if len(w) < 4 else 2 if len(w) < 9 else 3


def roster_names(roster: DataFrame, name_col: str) -> DataFrame:
    """(official, g1, s1): distinct folded words of every full name, its first given name and first surname.

    The last two words are surnames; names of fewer than three words and nulls are left out."""

    @F.pandas_udf("array<string>")
    def split(names: pd.Series) -> pd.Series:
        return names.map(lambda n: [w for w in person_words(n)] if n else [])

    w = roster.select(split(F.col(name_col)).alias("official")).where(F.size("official") >= 3).distinct()
    return w.select("official", F.element_at("official", 1).alias("g1"), F.element_at("official", -2).alias("s1"))


def parse_spellings(spellings: DataFrame, text_col: str) -> DataFrame:
    """Adds kind (missing, body or person) and words (of persons) to distinct spellings."""

    @F.pandas_udf("struct<kind string, words array<string>>")
    def parse(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            if is_missing(t):
                out.append(("missing", []))
            elif is_body(t):
                out.append(("body", []))
            else:
                out.append(("person", person_words(t)))
        return pd.DataFrame(out, columns=["kind", "words"])

    # written once: parsing is costly, and a filter on its result would be pushed below the distinct
    p = cut(spread(spellings, text_col).withColumn("__p", parse(F.col(text_col))))
    return p.withColumns({"kind": F.col("__p.kind"), "words": F.col("__p.words")}).drop("__p")


def near_words_by_trie(words: DataFrame, official: DataFrame) -> DataFrame:
    """(word, near): every distinct typed word with the official words within its radius, by a trie of checked size."""
    rows = official.select(F.explode("official").alias("w")).distinct().limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"over {MOST_WORDS} different words in official names")
    listed = sorted(r[0] for r in rows)
    trie = Trie()
    for i, w in enumerate(listed):
        trie.add(w, i)
    shared = words.sparkSession.sparkContext.broadcast((trie, listed))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t, names = shared.value
        for b in batches:
            yield pd.DataFrame({"word": b["word"], "near": [sorted({names[e] for _, e, _ in t.search(w, word_radius(w))}) for w in b["word"]]})

    return words.mapInPandas(search, "word string, near array<string>").select("word", F.explode("near").alias("near"))


def resolve_persons(persons: DataFrame, near: DataFrame, official: DataFrame) -> DataFrame:
    """(spelling, person): persons is (spelling, words); near is (word, near); official comes from roster_names.

    Candidates are the roster entries whose first given name and first surname both are near a word of the spelling,
    found by an equi-join on that pair; the nearest by ``person_cost`` wins, ties by name. A spelling that meets no
    entry stands for itself: its person is its own sorted words. ``person`` is text.
    """
    word = persons.select("spelling", F.explode("words").alias("word"))
    rows = official.select("g1").distinct().limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"over {MOST_WORDS} different given names")
    given = sorted(r[0] for r in rows)

    @F.pandas_udf("array<string>")
    def readings(w: pd.Series) -> pd.Series:
        return w.map(lambda x: given_readings(x, given))

    short = word.select("word").distinct().select("word", F.explode(readings("word")).alias("near"))
    read = near.unionByName(short).distinct()
    cand = word.join(read, "word").select("spelling", "near").distinct()
    g = cand.join(official.select(F.col("g1").alias("near")).distinct(), "near", "left_semi").select("spelling", F.col("near").alias("g1"))
    s = cand.join(official.select(F.col("s1").alias("near")).distinct(), "near", "left_semi").select("spelling", F.col("near").alias("s1"))
    pair = g.join(s, "spelling").join(official, ["g1", "s1"]).join(persons, "spelling").select("spelling", "words", "official")

    @F.pandas_udf("double")
    def cost(words: pd.Series, off: pd.Series) -> pd.Series:
        return pd.Series([person_cost(list(w), list(o)) for w, o in zip(words, off)], dtype="float64")

    scored = pair.select("spelling", F.concat_ws(" ", "official").alias("person"), cost("words", "official").alias("cost")).where(F.col("cost") <= MOST_COST)
    best = scored.groupBy("spelling").agg(F.min(F.struct("cost", "person")).alias("b")).select("spelling", "b.person")
    return persons.join(best, "spelling", "left").select("spelling", F.coalesce("person", F.concat(F.lit("~"), F.concat_ws(" ", F.array_sort("words")))).alias("person"))


def person_of_spelling(records: DataFrame, text_col: str, roster: DataFrame, roster_col: str) -> DataFrame:
    """(spelling, kind, person) of every distinct non-null text; person is null unless kind is person."""
    parsed = parse_spellings(records.select(F.col(text_col).alias("spelling")).where("spelling IS NOT NULL").distinct(), "spelling")
    persons = parsed.where("kind = 'person'").select("spelling", "words")
    official = roster_names(roster, roster_col)
    near = near_words_by_trie(persons.select(F.explode("words").alias("word")).distinct(), official)
    done = resolve_persons(persons, near, official)
    return parsed.select("spelling", "kind").join(done, "spelling", "left")


__all__ = ["fold", "near_words_by_trie", "parse_spellings", "person_of_spelling", "resolve_persons", "roster_names", "word_radius"]
