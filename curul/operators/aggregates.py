"""Aggregates over records: fixed categories, tallies, ratios, first and most frequent values, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_counts(rows: DataFrame, keys: list[str], col: str, categories: list[str], prefix: str = "n_") -> DataFrame:
    """One count per category, zeros kept; values outside the list are not counted."""
    name = lambda c: prefix + "".join(x if x.isalnum() else "_" for x in c)
    return rows.groupBy(*keys).agg(*[F.count_if(F.col(col) == c).alias(name(c)) for c in categories])


def participation(f: Column, c: Column, a: Column, absent: Column) -> dict[str, Column]:
    """total, participation and unity; a ratio over nothing is null."""
    cast = f + c + a
    return {"total": cast + absent, "participation": F.try_divide(cast, cast + absent), "unity": F.try_divide(F.greatest(f, c, a), cast)}


def most_frequent(rows: DataFrame, keys: list[str], col: str, out: str = "value") -> DataFrame:
    """(keys, value, n): the most frequent non-null value; among ties the smallest. Two aggregations, both partial first."""
    per = rows.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("k"), F.col(col).alias("v"))).alias("b")).select(*keys, F.col("b.v").alias(out), (-F.col("b.k")).alias("n"))


def first_by(rows: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The columns of each key's first row by the order."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in cols if c not in order])).alias("b")).select(*keys, *[F.col(f"b.{c}").alias(c) for c in cols])


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the first by the order; null keys are kept apart, each as it is."""
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    picked = rows.where(known).groupBy(*keys).agg(F.min(F.struct(*order, *[c for c in rows.columns if c not in order and c not in keys])).alias("b"))
    first = picked.select(*[F.col(k) if k in keys and k not in order else F.col(f"b.{k}").alias(k) for k in rows.columns])
    return first.unionByName(rows.where(~known))


def best_by_preference(rows: DataFrame, keys: list[str], rank_col: str, preference: list, order: list[str], cols: list[str]) -> DataFrame:
    """The first row whose rank comes earliest in the preference list; ranks outside it come last."""
    at = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(rank_col))
    place = F.when(at > 0, at).otherwise(len(preference) + 1)
    return first_by(rows.withColumn("__place", place), keys, ["__place", *order], cols)


def pivot_values(rows: DataFrame, row_keys: list[str], col: str, value: str, columns: list[str], default: str = "-") -> DataFrame:
    """One column per listed value; the default where there is no row, null where there is a row without value."""
    p = rows.groupBy(*row_keys).pivot(col, columns).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("v"))
    return p.select(*row_keys, *[F.when(F.coalesce(F.col(f"`{c}_n`"), F.lit(0)) == 0, default).otherwise(F.col(f"`{c}_v`").cast("string")).alias(c) for c in columns])


def examples(rows: DataFrame, keys: list[str], col: str, most: int = 8) -> DataFrame:
    """(keys, n, examples): the count and the smallest distinct examples, at most so many; the aggregate buffer holds
    distinct values only as long as they can still be among them."""
    per = rows.groupBy(*keys, col).agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    r = per.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(col).asc_nulls_last())))
    return r.groupBy(*keys).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.when(F.col("__r") <= most, F.col(col)))).alias("examples"))


def committee_profile(members: DataFrame, key: str, name: str, role: str, gender: str, order: str, woman: str = "Mujer") -> DataFrame:
    """Members by gender, the last president and secretary by order, and the other members' names in order."""
    is_p, is_s = F.col(role) == "Presidencia", F.col(role) == "Secretaría"
    return members.groupBy(key).agg(
        F.count("*").alias("members"), F.count_if(F.col(gender) == woman).alias("women"), F.count_if(F.coalesce(F.col(gender) != woman, F.lit(True))).alias("men"),
        F.max_by(name, F.when(is_p, F.col(order))).alias("president"), F.coalesce(F.max_by(gender, F.when(is_p, F.col(order))) == woman, F.lit(False)).cast("int").alias("president_is_woman"),
        F.max_by(name, F.when(is_s, F.col(order))).alias("secretary"), F.count_if(is_s).alias("secretaries"),
        F.transform(F.sort_array(F.collect_list(F.when(~is_p & ~is_s, F.struct(order, name)))), lambda x: x[name]).alias("others"),
    )


def document_frequency(docs: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """(word, df, idf): in how many documents a word is, and ln((n + 1) / (df + 0.5)) over all n documents."""
    per = docs.select(id_col, F.explode(F.array_distinct(words_col)).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("docs"))
    return per.join(F.broadcast(n)).select("word", "df", F.log((F.col("docs") + 1) / (F.col("df") + 0.5)).alias("idf"))
