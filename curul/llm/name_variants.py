"""Variant spellings of names: metric-space partitioning with exact radius joins.

The metric is Levenshtein distance, a true metric, over single name words and over whole names with their words in
order. Pivots are texts of the stock. Every stock text lives in the cell of its nearest pivot; a typed text x with
radius r is sent to each cell whose pivot p has d(x, p) <= d(x, nearest pivot) + 2r and d(x, p) <= r + radius(cell),
which by the triangle inequality are all cells that can hold a stock text within r. Inside a cell the join is exact.
Whole names within their radius are proposed as they are; names that are turned, shortened or lack a part are far from
their full form under any edit distance, so what their words may stand for proposes them, by equi-joins on words
brought to one form by the radius join. A comparison of whole names decides.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curul.functions.names import acronym, acronym_keys, body_words, same_body
from curul.functions.unicode_text import is_missing
from curul.operators.components import connected_components
from curul.operators.name_resolution import parse_spellings, resolve_persons, roster_names
from curul.plans.spread import spread
from curul.plans.state import cut

#: Stock entries of a cell that one task compares with what was sent there; larger cells are split.
CELL_BLOCK = 2000


def word_radius(word: Column) -> Column:
    """0 under three letters, 1 for three, 2 up to eight, 3 beyond."""
    n = F.length(word)
    return F.when(n < 3, 0).when(n < 4, 1).when(n < 9, 2).otherwise(3)


def key_radius(key: Column) -> Column:
    """For whole names: one edit in eight letters, three at most; none under eight."""
    return F.least(F.lit(3), F.floor(F.length(key) / 8)).cast("int")


def radius_join(typed: DataFrame, stock: DataFrame, radius: Callable[[Column], Column] = word_radius, pivots: int | None = None) -> DataFrame:
    """(word, near, distance): every typed text with all stock texts within its radius.

    typed and stock are distinct texts in a column ``word``. The radius follows the typed text's length. There are as
    many pivots as the root of the stock's size (16 to 1,024), chosen by hash; cells of over CELL_BLOCK texts are split
    by hash and what is sent to them is sent to each part. Nulls are left out; an empty side gives no rows.
    """
    typed, stock = typed.where("word IS NOT NULL"), stock.where("word IS NOT NULL")
    pivots = pivots or min(1024, max(16, int(stock.count() ** 0.5)))
    chosen = [r[0] for r in stock.orderBy(F.xxhash64("word"), "word").limit(pivots).collect()]
    if not chosen:
        return typed.select("word", F.col("word").alias("near"), F.lit(0).alias("distance")).limit(0)
    to_all = F.transform(F.array(*[F.lit(p) for p in chosen]), lambda p, k: F.struct(F.levenshtein(F.col("word"), p).alias("d"), k.alias("cell")))
    home = cut(spread(stock, "word").select("word", F.array_min(to_all).alias("h")).select(F.col("word").alias("near"), "h.cell", F.col("h.d").alias("dp")))
    cells = {r[0]: (r[1], 1 + r[2] // CELL_BLOCK) for r in home.groupBy("cell").agg(F.max("dp"), F.count("*")).collect()}  # one row a pivot
    far, parts = (F.array(*[F.lit(cells.get(k, (-1, 1))[j]) for k in range(len(chosen))]) for j in (0, 1))
    sent = spread(typed, "word").withColumns({"all": to_all, "r": radius(F.col("word"))}).withColumn("least", F.array_min("all")["d"])
    reached = (F.col("c.d") <= F.col("least") + 2 * F.col("r")) & (F.col("c.d") <= F.col("r") + F.get(far, F.col("c.cell")))
    sent = sent.select("word", "r", "least", F.explode("all").alias("c")).where(reached).select("word", "r", "c.cell")
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("cell")) - 1)))
    home = home.withColumn("part", F.pmod(F.xxhash64("near"), F.get(parts, F.col("cell"))).cast("int"))
    return sent.join(home, ["cell", "part"]).withColumn("distance", F.levenshtein("word", "near")).where("distance <= r").select("word", "near", "distance")


#: Parties in the reference list; more raise, since the list goes to every worker.
MOST_PARTIES = 20_000
#: Rarest words of a body by which it looks for others.
PROBES = 2


def spellings_of(records: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, spelling): the distinct texts, compared character by character, each with its smallest id; nulls left out."""
    return records.where(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("spelling")).agg(F.min(id_col).alias("rep"))


def body_entities(spelled: DataFrame, party_names: dict[str, str]) -> DataFrame:
    """(field, rep, entity) of spellings (field, rep, spelling) of bodies or parties: entity is the same for all spellings
    of a field that name the same one. Spellings of different fields are never linked."""

    @F.pandas_udf("struct<words array<string>, acronym string, acronyms array<string>>")
    def parse(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            w, a = body_words(t, party_names), acronym(t)
            if a and a in party_names:
                w, a = body_words(party_names[a]), None
            out.append(([] if a else w, a, acronym_keys(w) if not a else [a]))
        return pd.DataFrame(out, columns=["words", "acronym", "acronyms"])

    parsed = spelled.withColumn("p", parse("spelling")).select("field", "rep", F.concat_ws("|", "field", "rep").alias("node"), "p.*")
    parsed = cut(parsed)
    plain = parsed.select("node", "field", F.explode("words").alias("word")).where(~F.col("word").endswith("."))
    support = plain.groupBy("word").agg(F.count("*").alias("n"))
    near = radius_join(support.select("word"), support.select("word"))
    # a misspelt word is led to the word near it that most spellings have
    led = near.join(support.select(F.col("word").alias("near"), "n"), "near").groupBy("word").agg(F.min(F.struct(-F.col("n"), "distance", "near"))["near"].alias("key"))
    # All words of the shorter of two names for one body are met in the longer, so the shorter's rarest words find it;
    # words that head many bodies propose nothing where a body has rarer ones.
    words = cut(plain.join(led, "word").select("field", "node", "key").distinct())
    often = words.groupBy("field", "key").agg(F.count("*").alias("n"))
    rare = words.join(often, ["field", "key"]).groupBy("field", "node").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "key"))), 1, PROBES).alias("r"))
    probe = rare.select("field", "node", F.explode("r.key").alias("key"))
    letters = parsed.select("field", "node", F.explode(F.transform("acronyms", lambda x: F.concat(F.lit("#"), x))).alias("key"))
    single = parsed.where("acronym IS NOT NULL").select("field", "node", F.concat(F.lit("#"), "acronym").alias("key"))
    index = lambda x: x.withColumnRenamed("node", "other")
    by_words = probe.join(index(words), ["field", "key"]).unionByName(single.join(index(letters), ["field", "key"]))
    # whole names within their radius of one another
    whole = parsed.select("field", "node", F.concat_ws(" ", F.array_sort("words")).alias("whole")).where("whole <> ''")
    close = radius_join(whole.select(F.col("whole").alias("word")).distinct(), whole.select(F.col("whole").alias("word")).distinct(), key_radius)
    by_whole = close.join(whole.withColumnRenamed("whole", "word"), "word").join(whole.select(F.col("field").alias("f"), F.col("node").alias("other"), F.col("whole").alias("near")), "near").where("field = f").select("node", "other")
    both = by_words.select("node", "other").unionByName(by_whole).where("node <> other")
    pair = both.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other")).distinct()
    side = parsed.select(F.col("node").alias("other"), F.col("words").alias("words_o"), F.col("acronym").alias("acronym_o"), F.col("acronyms").alias("acronyms_o"))

    @F.pandas_udf("boolean")
    def same(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_body(list(x), list(y)) for x, y in zip(a, b)], dtype=bool)

    p = pair.join(parsed, "node").join(side, "other")
    by_letters = F.coalesce(F.array_contains("acronyms_o", F.col("acronym")), F.lit(False)) | F.coalesce(F.array_contains("acronyms", F.col("acronym_o")), F.lit(False))
    links = p.withColumn("same", same("words", "words_o")).where(by_letters | F.col("same")).select("node", "other")
    comp = connected_components(links, "node", "other")
    return parsed.join(comp, "node", "left").select("field", "rep", F.coalesce("component", "node").alias("entity"))


def _missing(spelled: DataFrame) -> DataFrame:
    @F.pandas_udf("boolean")
    def missing(texts: pd.Series) -> pd.Series:
        return texts.map(is_missing).astype(bool)

    return spelled.withColumn("missing", missing("spelling")).where("NOT missing").drop("missing")


def person_entities(persons: DataFrame, roster: DataFrame, roster_col: str) -> DataFrame:
    """(spelling, person) of parsed persons (spelling, words): resolved to the roster of official names by the words
    within their radius; those that meet no official name are linked by whole names within their radius."""
    official = cut(roster_names(roster, roster_col))
    near = radius_join(persons.select(F.explode("words").alias("word")).distinct(), official.select(F.explode("official").alias("word")).distinct())
    known = cut(resolve_persons(persons, near.select("word", "near"), official))
    # the rest, by their whole names: those within their radius of one another are one person
    off = known.where(F.col("person").startswith("~")).select(F.col("person").alias("word")).distinct()
    links = radius_join(off, off, key_radius).where("word < near")
    comp = connected_components(links, "word", "near").select(F.col("node").alias("person"), "component")
    return known.join(comp, "person", "left").select("spelling", F.coalesce("component", "person").alias("person"))


def variant_entities(records: DataFrame, id_col: str, presenter_col: str, party_col: str, roster: DataFrame, roster_col: str, parties: DataFrame, short_col: str, name_col: str, aliases: dict[str, str]) -> DataFrame:
    """(field, rep, spelling, kind, entity): what each spelling of presenters and parties names.

    Persons are resolved to the roster; bodies and parties are linked among the spellings of their field. The list of
    parties (of a checked size) adds its names as spellings; short names and ``aliases`` (folded text to short name)
    stand for the names. Missing values are no spellings. A parliamentary group is a body, apart from its party.
    """
    rows = parties.select(short_col, name_col).where(F.col(short_col).isNotNull() & F.col(name_col).isNotNull()).limit(MOST_PARTIES + 1).collect()
    if len(rows) > MOST_PARTIES:
        raise ValueError(f"over {MOST_PARTIES} parties in the reference list")
    names = {r[0].lower(): r[1] for r in rows}
    names |= {k: names[v.lower()] for k, v in aliases.items() if v.lower() in names}
    who = parse_spellings(spellings_of(records, id_col, presenter_col), "spelling")
    what = _missing(spellings_of(records, id_col, party_col))
    one = cut(who.where("kind <> 'missing'").select(F.lit(presenter_col).alias("field"), "rep", "spelling", "kind", "words").unionByName(what.select(F.lit(party_col).alias("field"), "rep", "spelling", F.lit("party").alias("kind"), F.array().cast("array<string>").alias("words"))))
    people = person_entities(one.where("kind = 'person'").select("spelling", "words"), roster, roster_col)
    persons = one.where("kind = 'person'").join(people, "spelling").select("field", "rep", "spelling", "kind", F.col("person").alias("entity"))
    rep_type = one.schema["rep"].dataType
    extra = records.sparkSession.createDataFrame([(-1 - k, r[1]) for k, r in enumerate(sorted(rows))], "rep bigint, spelling string").select(F.lit(party_col).alias("field"), F.col("rep").cast(rep_type).alias("rep"), "spelling")
    rest = one.where("kind <> 'person'")
    linked = body_entities(rest.select("field", "rep", "spelling").unionByName(extra), names)
    return persons.unionByName(rest.join(linked, ["field", "rep"]).select("field", "rep", "spelling", "kind", F.concat(F.lit("#"), "entity").alias("entity")))


def spelling_pairs(entities: DataFrame, field: str = "field") -> DataFrame:
    """(field, rep_a, rep_b), rep_a < rep_b: every pair of spellings of one entity of one field."""
    a = entities.select(field, "entity", F.col("rep").alias("rep_a"))
    return a.join(entities.select(field, "entity", F.col("rep").alias("rep_b")), [field, "entity"]).where("rep_a < rep_b").select(field, "rep_a", "rep_b")
