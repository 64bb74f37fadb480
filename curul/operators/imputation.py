"""Filling missing values: verified dependencies first, then the usual value of the group, with provenance."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.plans.state import cut


def dictionary(records: DataFrame, determinant: list[str], target: str) -> DataFrame:
    """(__d0, __d1, ..., value, n, total, second): the most frequent target value of each determinant.

    Only records in which all of them are known count. ``second`` is the count of the runner-up (0 when none): a tie
    shows as second = n. Among tied values the smallest is kept, so the result is the same on every run. All three
    aggregations combine on the map side; a hot determinant reaches the join as one row a value.
    """
    keys = [f"__d{k}" for k in range(len(determinant))]
    known = records.select(*[F.col(c).alias(k) for c, k in zip(determinant, keys)], F.col(target).alias("value")).dropna()
    counts = known.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    top = counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("b"))
    rest = counts.join(top.select(*keys, F.col("b.value").alias("__best")), keys).where("value <> __best").groupBy(*keys).agg(F.max("n").alias("second"))
    return top.join(rest, keys, "left").select(*keys, F.col("b.value").alias("value"), (-F.col("b.k")).alias("n"), "total", F.coalesce("second", F.lit(0)).alias("second"))


def mine_dependencies(records: DataFrame, determinants: list[list[str]], target: str, least_confidence: float = 0.95, least_support: int = 2) -> DataFrame:
    """One row per candidate: (determinant, target, records, groups, agreeing, confidence, verified).

    confidence is the share of complete records, in groups of at least ``least_support``, that carry their group's
    most frequent value. Without such groups confidence is null and the dependency isn't verified. All candidates share
    one pass: a record goes into the counts once per candidate, with 64 bits for the determinant's values, and the
    counts combine on the map side.
    """
    stats = _statistics(records, determinants, target, least_support)
    names = records.sparkSession.createDataFrame([(k, "+".join(d)) for k, d in enumerate(determinants)], "c int, determinant string")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    out = names.join(stats, "c", "left").select("determinant", F.lit(target).alias("target"), zero("records"), zero("groups"), zero("agreeing"), F.expr("try_divide(agreeing, records)").alias("confidence"))
    return out.withColumn("verified", F.coalesce(F.col("confidence") >= least_confidence, F.lit(False)))


def _statistics(records: DataFrame, determinants: list[list[str]], target: str, least_support: int) -> DataFrame:
    """(c, records, groups, agreeing) of the candidates, by place, that have groups."""
    entry = [F.when(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in d)), F.struct(F.lit(k).alias("c"), F.xxhash64(*d).alias("k"))) for k, d in enumerate(determinants)]
    long = records.where(F.col(target).isNotNull()).select(F.col(target).alias("value"), F.explode(F.array_compact(F.array(*entry))).alias("e"))
    counts = long.groupBy("e.c", "e.k", "value").agg(F.count("*").alias("n"))
    groups = counts.groupBy("c", "k").agg(F.sum("n").alias("total"), F.max("n").alias("most")).where(F.col("total") >= least_support)
    return groups.groupBy("c").agg(F.sum("total").alias("records"), F.count("*").alias("groups"), F.sum("most").alias("agreeing"))


def find_dependencies(records: DataFrame, columns: list[str], target: str, most_columns: int = 2, least_confidence: float = 0.95) -> list[list[str]]:
    """The sets of up to ``most_columns`` of the columns that the complete records bear out as determinants of the target.

    Surest first; among equally sure ones those of more columns, which claim less, then those that more records bear out.
    A column that is unique shows no groups and is never verified. One row a candidate comes to the driver.
    """
    sets = [list(d) for k in range(1, most_columns + 1) for d in combinations(columns, k)]
    rows = [(r["agreeing"] / r["records"], sets[r["c"]], r["records"]) for r in _statistics(records, sets, target, 2).collect()]
    rows = sorted((-sure, -len(d), -n, d) for sure, d, n in rows if sure >= least_confidence)
    return [d for *_, d in rows]


#: A key in at least this share of the rows to fill is hot; there are at most the reciprocal of it, so their dictionary
#: entries are broadcast, and no other key makes a large group of a join.
HOT_SHARE = 1e-3


def fill_missing(records: DataFrame, target: str, dependencies: list[list[str]], group: list[str] | None = None, filled_col: str | None = None, source_col: str | None = None) -> DataFrame:
    """All rows, with the target filled and where each value came from.

    Dependencies are tried in order by left joins to their dictionaries; a dictionary entry counts only if its value
    isn't tied. Then the group's most frequent value, likewise untied. ``source_col`` is observed, dependency:<cols>,
    group:<cols>, or null where the value stays missing. Null determinants never match; repeated rows are filled alike;
    an empty table gives an empty result. Columns of the two output names are replaced.

    Only rows that lack the value and have the determinant enter a join; the others pass by. Hot keys (HOT_SHARE) find
    their entry in a broadcast of bounded size, the rest by a join in which no key is hot.
    """
    filled_col, source_col = filled_col or f"{target}_filled", source_col or f"{target}_source"
    out = records.withColumns({filled_col: F.col(target), source_col: F.when(F.col(target).isNotNull(), F.lit("observed"))})
    steps = [*(("dependency", d) for d in dependencies), *([("group", group)] if group else [])]
    for at, (kind, cols) in enumerate(steps):
        keys = [f"__d{k}" for k in range(len(cols))]
        out = cut(out) if at else out
        lacks = F.col(filled_col).isNull()
        for c in cols:
            lacks = lacks & F.col(c).isNotNull()
        need = out.where(lacks)
        t = dictionary(records, cols, target).where("second < n").select(*keys, F.col("value").alias("__value"))
        # one row a key that is asked for, how often, and with its entry if there is one
        asked = need.groupBy(*[F.col(c).alias(k) for c, k in zip(cols, keys)]).agg(F.count("*").alias("__n"))
        entries = cut(asked.join(t, keys, "left"))
        total = entries.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        is_hot = F.col("__n") >= max(1.0, total * HOT_SHARE)
        hot, rest = F.broadcast(entries.where(is_hot).drop("__n")), entries.where(~is_hot).drop("__n")
        on = [F.col(c) == F.col(k) for c, k in zip(cols, keys)]
        known = F.when(F.col("__value").isNotNull(), F.lit(f"{kind}:{'+'.join(cols)}"))
        put = lambda rows: rows.withColumns({source_col: known, filled_col: F.col("__value")}).drop("__value", *keys)  # noqa: E731, B023
        by_hot, by_join = put(need.join(hot, on)), put(need.join(hot.select(*keys), on, "left_anti").join(rest, on))
        out = out.where(~lacks).unionByName(by_hot).unionByName(by_join)
    return out
