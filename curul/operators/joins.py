"""Joins of records: last wins, tie-breaks, as-of, bands, containment, one-to-one assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curul.operators.matching import greedy_matching


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the last by order; what a dictionary filled in that order holds."""
    rest = [c for c in rows.columns if c not in keys and c != order]
    return rows.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("b")).select(*keys, F.col(f"b.{order}").alias(order), *[F.col(f"b.{c}").alias(c) for c in rest])


def lookup_with_tie_break(left: DataFrame, right: DataFrame, on: list[str], id_col: str, better: Column, order: list[str]) -> DataFrame:
    """Left rows with at most one right row: of several, the first for which ``better`` holds, else the first by order.

    ``id_col`` identifies left rows; right columns must not clash with left ones beyond ``on``."""
    j = left.join(right, on, "left")
    w = Window.partitionBy(id_col).orderBy(F.when(better, 0).otherwise(1), *order)
    return j.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def reconcile(left: DataFrame, right: DataFrame, on: list[str], left_col: str, right_col: str) -> DataFrame:
    """(on..., left_col, right_col, outcome): equal, different, only_left or only_right over a full outer join.

    Two nulls are equal; a key that one side lacks shows as only the other."""
    a = left.select(*on, left_col, F.lit(True).alias("__l"))
    b = right.select(*on, right_col, F.lit(True).alias("__r"))
    j = a.join(b, on, "full_outer")
    outcome = F.when(F.col("__l").isNull(), "only_right").when(F.col("__r").isNull(), "only_left").when(F.col(left_col).eqNullSafe(F.col(right_col)), "equal").otherwise("different")
    return j.select(*on, left_col, right_col, outcome.alias("outcome"))


def asof(left: DataFrame, right: DataFrame, part: list[str], left_at: str, right_at: str, values: list[str], forward: bool = False, tolerance: Column | None = None) -> DataFrame:
    """Each left row with the nearest right row at or before it (after it, when forward), by one union and one window.

    No pairs are formed. A right row at the same place counts. ``tolerance`` is the largest distance in the unit of
    the places; beyond it the values are null. Right values must not be left columns."""
    a = left.select(*part, F.col(left_at).alias("__at"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(right.select(F.struct(right_at, *values).alias("s")).schema[0].dataType).alias("__r"))
    b = right.select(*part, F.col(right_at).alias("__at"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("s")).schema[0].dataType).alias("__l"), F.struct(right_at, *values).alias("__r"))
    u = a.unionByName(b)
    side = F.when(F.col("__r").isNotNull(), 0).otherwise(1)
    if forward:
        w = Window.partitionBy(*part).orderBy(F.col("__at").asc(), F.when(F.col("__r").isNotNull(), 1).otherwise(0)).rowsBetween(0, Window.unboundedFollowing)
        near = F.first("__r", ignorenulls=True).over(w)
    else:
        w = Window.partitionBy(*part).orderBy(F.col("__at").asc(), side).rowsBetween(Window.unboundedPreceding, 0)
        near = F.last("__r", ignorenulls=True).over(w)
    r = u.withColumn("__m", near).where("__l IS NOT NULL")
    ok = F.lit(True) if tolerance is None else F.abs(F.col(f"__m.{right_at}") - F.col("__at")) <= tolerance
    return r.select("__l.*", *[F.when(ok, F.col(f"__m.{v}")).alias(v) for v in values])


def band_join(left: DataFrame, right: DataFrame, on: list[str], left_day: str, right_day: str, days: int) -> DataFrame:
    """Pairs whose right day is at or before the left day, by at most so many days, as an equi-join on stretches of days.

    Days are dates; each right row enters the stretch it lies in and the next, so every pair meets exactly once."""
    width = max(1, days)
    stretch = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width)
    a = left.withColumn("__s", stretch(left_day))
    b = right.withColumn("__s", F.explode(F.array(stretch(right_day), stretch(right_day) + 1)))
    gap = F.datediff(F.col(left_day), F.col(right_day))
    return a.join(b, [*on, "__s"]).where((gap >= 0) & (gap <= days)).drop("__s")


def top_one(pairs: DataFrame, key: list[str], score: Column, order: list[str], least: float | None = None) -> DataFrame:
    """The best pair of each key: the highest score, ties by order; none below ``least``."""
    p = pairs.withColumn("score", score)
    p = p if least is None else p.where(F.col("score") >= least)
    return p.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("score").desc(), *order))).where("__r = 1").drop("__r")


def range_join(left: DataFrame, right: DataFrame, on: list[str], value: str, low: str, high: str, width: int) -> DataFrame:
    """Pairs with low <= value <= high as an equi-join on stretches of ``width``; a right row enters every stretch it spans."""
    a = left.withColumn("__s", F.floor(F.col(value) / width).cast("bigint"))
    b = right.where(F.col(low) <= F.col(high)).withColumn("__s", F.explode(F.sequence(F.floor(F.col(low) / width).cast("bigint"), F.floor(F.col(high) / width).cast("bigint"))))
    return a.join(b, [*on, "__s"]).where((F.col(value) >= F.col(low)) & (F.col(value) <= F.col(high))).drop("__s")


def phrases_in(texts: DataFrame, id_col: str, text_col: str, phrases: list[str], most: int | None = None) -> DataFrame:
    """(id, phrases): which phrases of a fixed list stand in a text, longest first, not overlapping, by first position.

    Whole words, case and accents aside. One expression finds all places in one pass: alternatives are ordered longest
    first, so what a longer phrase covers is gone for a shorter one. Null texts give an empty array."""
    from curul.functions.text import fold
    from curul.functions.unicode_text import fold as fold_text

    import re

    listed = sorted({fold_text(p) for p in phrases if p}, key=lambda p: (-len(p), p))
    pattern = r"(?<![\p{L}\p{Nd}])(" + "|".join(re.escape(p) for p in listed) + r")(?![\p{L}\p{Nd}])"
    found = F.array_distinct(F.regexp_extract_all(fold(text_col), F.lit(pattern), F.lit(1))) if listed else F.array().cast("array<string>")
    found = F.coalesce(found, F.array().cast("array<string>"))
    return texts.select(id_col, (F.slice(found, 1, most) if most else found).alias("phrases"))


def greedy_assignment(pairs: DataFrame, block: list[str], i: str, j: str, score: str, similarity: str, least: float, least_single: float) -> DataFrame:
    """(block..., i, j, similarity): one-to-one pairs of each block, taken from the highest score down.

    Pairs below ``least`` are not taken (``least_single`` in blocks of one by one). Ties fall to the higher
    similarity, then the larger i, then the larger j. Pairs below both limits are dropped first; no task has a whole
    block (see ``greedy_matching``).
    """
    sized = pairs.where(F.col(similarity) >= min(least, least_single))
    n = pairs.groupBy(*block).agg((F.count_distinct(i).alias("__ni")), F.count_distinct(j).alias("__nj"))
    sized = sized.join(n, block)
    sized = sized.where((F.col(similarity) >= least) | ((F.col("__ni") == 1) & (F.col("__nj") == 1) & (F.col(similarity) >= least_single)))
    order = F.struct(F.col(score), F.col(similarity), F.col(i), F.col(j))
    return greedy_matching(sized.select(*block, i, j, similarity, score), [*block, i], [*block, j], order, F.max).select(*block, i, j, similarity)


def coalesce_merge(base: DataFrame, others: list[DataFrame], key: str, fields: list[str]) -> DataFrame:
    """Rows of the base with each field from the first source, base first, that has it; sources must have one row a key."""
    out = base
    for k, o in enumerate(others):
        out = out.join(o.select(key, *[F.col(f).alias(f"__{k}_{f}") for f in fields]), key, "left")
    return out.select(key, *[F.coalesce(F.col(f), *[F.col(f"__{k}_{f}") for k in range(len(others))]).alias(f) for f in fields], *[c for c in base.columns if c != key and c not in fields])


def fuzzy_lookup(left: DataFrame, right: DataFrame, left_col: str, right_col: str, least: float = 0.9) -> DataFrame:
    """(left, right, ratio) of distinct left texts: the same text, else the nearest by sequence ratio at or above ``least``.

    Only texts that aren't found as they are go further; candidates share a word or the first letters of one, by an
    equi-join, before the ratio is taken. Unmatched texts give null."""
    from curul.functions.cleaning import alnum_words
    from curul.functions.similarity import sequence_ratio

    a = left.select(F.col(left_col).alias("left"), alnum_words(left_col).alias("__a")).where("left IS NOT NULL").distinct()
    b = right.select(F.col(right_col).alias("right"), alnum_words(right_col).alias("__b")).where("right IS NOT NULL").distinct()
    first = b.groupBy("__b").agg(F.min("right").alias("right"))
    exact = a.join(first, a["__a"] == first["__b"]).select("left", "right", F.lit(1.0).alias("ratio"))
    rest = a.join(exact.select("left"), "left", "left_anti")
    keys = lambda c: F.explode(F.array_distinct(F.flatten(F.transform(F.split(c, " "), lambda w: F.array(F.substring(w, 1, 3), F.concat(F.lit("~"), F.substring(w, -3, 3)))))))
    pair = rest.select("left", "__a", keys("__a").alias("k")).join(b.select("right", "__b", keys("__b").alias("k")), "k").select("left", "__a", "right", "__b").distinct()
    near = pair.where(F.length("__a") * 2 * least <= (F.length("__a") + F.length("__b")) * 1.0 + 1e-9).withColumn("ratio", sequence_ratio("__a", "__b")).where(F.col("ratio") >= least)
    best = near.groupBy("left").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "right")).alias("m")).select("left", F.col("m.right").alias("right"), (-F.col("m.r")).alias("ratio"))
    return exact.unionByName(rest.select("left").join(best, "left", "left").select("left", "right", "ratio"))
