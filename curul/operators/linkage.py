"""Linking later events to earlier records in order of time: what is linked leaves the pool."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curul.functions.similarity import stems
from curul.operators.matching import greedy_matching
from curul.plans.state import cut

# Events and records that one task compares.
BLOCK = 4096


def candidate_links(events: DataFrame, event: str, event_day: str, event_text: str, records: DataFrame, record: str, record_day: str, record_text: str, least: float, block: int = BLOCK) -> DataFrame:
    """(event, event_day, record, similarity): all pairs of an event and a record that isn't later, with stem similarity
    (Dice) at or above ``least``.

    Nothing else is asked of a pair. At low limits a filter by the rarest stems keeps nearly all pairs, so common stems
    are counted instead: blocks of events meet blocks of records, and each record adds up the lists of events of its stems."""
    side = lambda df, i, day, text: df.select(F.col(i).alias("i"), F.col(day).alias("day"), F.datediff(day, F.lit("1970-01-01").cast("date")).alias("at"), stems(F.col(text)).alias("stems"))
    es, rs = cut(side(events, event, event_day, event_text)), cut(side(records, record, record_day, record_text))
    n_e, n_r = (max(1, -(-df.count() // block)) for df in (es, rs))
    hashed = lambda n: F.pmod(F.xxhash64("i"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = es.withColumn("be", hashed(n_e)).withColumn("br", every(n_r))
    b = rs.drop("day").withColumn("br", hashed(n_r)).withColumn("be", every(n_e))
    cols = [event, event_day, record, "similarity"]

    def compare(e: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(e) or not len(r):
            return pd.DataFrame(columns=cols)
        e = e.sort_values("at", kind="stable").reset_index(drop=True)
        at, size = e["at"].to_numpy(), e["stems"].map(len).to_numpy()
        codes, known = pd.factorize(np.concatenate(e["stems"].tolist()))
        holders = np.repeat(np.arange(len(e)), size)[np.argsort(codes, kind="stable")]
        lists = np.split(holders, np.cumsum(np.bincount(codes, minlength=len(known)))[:-1]) if len(known) else []
        size_r = r["stems"].map(len).to_numpy()
        found = pd.Index(known).get_indexer(np.concatenate(r["stems"].tolist())) if len(known) else np.full(size_r.sum(), -1)
        ends, firsts = np.cumsum(size_r), np.searchsorted(at, r["at"].to_numpy())
        who, which, how = [], [], []
        for k, (end, n, first) in enumerate(zip(ends.tolist(), size_r.tolist(), firsts.tolist())):
            mine = [lists[c] for c in found[end - n : end].tolist() if c >= 0]
            if first == len(e) or not mine and least > 0:
                continue
            common = np.bincount(np.concatenate(mine), minlength=len(e))[first:] if mine else np.zeros(len(e) - first)
            s = 2 * common / np.maximum(size[first:] + n, 1)
            near = np.flatnonzero(s >= least)
            who.append(near + first)
            which.append(np.full(len(near), k))
            how.append(s[near])
        if not who:
            return pd.DataFrame(columns=cols)
        x, y = np.concatenate(who), np.concatenate(which)
        return pd.DataFrame({event: e["i"].to_numpy()[x], event_day: e["day"].to_numpy()[x], record: r["i"].to_numpy()[y], "similarity": np.concatenate(how)}, columns=cols)

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"`{event}` {kind(events, event)}, `{event_day}` {kind(events, event_day)}, `{record}` {kind(records, record)}, similarity double"
    return a.groupBy("be", "br").cogroup(b.groupBy("be", "br")).applyInPandas(compare, schema)


def weighted_dice_links(left: DataFrame, right: DataFrame, left_id: str, right_id: str, stems_col: str, least: float) -> DataFrame:
    """(left, right, score): pairs whose stems are alike at or above ``least`` by Dice weighted with inverse document
    frequency, ln((n + 1) / (df + 0.5)) over the right side; a stem that it lacks weighs as one that no document has.

    Only pairs that share a stem of their prefix are compared, and none is lost: with stems from rare to common, a pair
    at ``least`` must share one among the left text's first stems, up to where the rest weighs under least / 2 of it.
    """
    n = right.count()
    df = right.select(F.explode(stems_col).alias("stem")).groupBy("stem").agg(F.count("*").alias("df"))
    weight = lambda c: F.log((F.lit(n) + 1) / (F.coalesce(c, F.lit(0)) + 0.5))

    def weighed(rows: DataFrame, i: str) -> DataFrame:
        return rows.select(F.col(i).alias("i"), F.explode(stems_col).alias("stem")).join(df, "stem", "left").select("i", "stem", weight(F.col("df")).alias("w"))

    def whole(long: DataFrame) -> DataFrame:
        return long.groupBy("i").agg(F.collect_list(F.struct("stem", "w")).alias("s"), F.sum("w").alias("whole"))

    la, lb = cut(weighed(left, left_id)), cut(weighed(right, right_id))
    a, b = whole(la), whole(lb)
    # twice the common weight is at least least (A + B), and the common weight is at most B, so it is at least least / (2 - least) A
    own = Window.partitionBy("i")
    earlier = F.coalesce(F.sum("w").over(own.orderBy(F.desc("w"), "stem").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    prefix = la.withColumns({"earlier": earlier, "all": F.sum("w").over(own)}).where(F.col("all") - F.col("earlier") >= least / (2 - least) * F.col("all") - 1e-9)
    p = prefix.select(F.col("i").alias("left"), "stem").join(lb.select(F.col("i").alias("right"), "stem"), "stem")
    p = p.select("left", "right").distinct().join(a.select(F.col("i").alias("left"), F.col("s").alias("sa"), F.col("whole").alias("wa")), "left").join(b.select(F.col("i").alias("right"), F.col("s").alias("sb"), F.col("whole").alias("wb")), "right")
    common = F.aggregate(F.array_intersect("sa", "sb"), F.lit(0.0), lambda t, y: t + y["w"])
    return p.select("left", "right", F.coalesce(F.try_divide(2 * common, F.col("wa") + F.col("wb")), F.lit(0.0)).alias("score")).where(F.col("score") >= least)


def link_in_order(pairs: DataFrame, group: list[str], day: str, event: str, record: str, similarity: str) -> DataFrame:
    """(group..., day, event, record, similarity): day by day, the best pairs first, each event and record once a group.

    A record linked on one day is gone on later days. Ties fall to the smaller event, then the smaller record. An empty
    ``group`` is one order over all pairs. No task goes through a group's pairs: see ``greedy_matching``.
    """
    cols = [*group, day, event, record, similarity]
    order = F.struct(F.col(day), (-F.col(similarity)).alias("s"), F.col(event), F.col(record))
    return greedy_matching(pairs.select(*cols), [*group, event], [*group, record], order)


def review_list(pairs: DataFrame, linked: DataFrame, events: DataFrame, event: str, record: str, similarity: str, low: float = 0.7, near: float = 0.05, many: int = 8) -> DataFrame:
    """(event, reason, similarity): what of a linkage a person should look at.

    low_similarity: linked below ``low``. near_tie: another record within ``near`` of the one linked. ambiguous: more
    than ``many`` records within a tenth of the best. unlinked: no record. One aggregation over the pairs of each event.
    """
    top = pairs.groupBy(event).agg(F.max(similarity).alias("__top"))
    close = pairs.join(top, event).groupBy(event).agg(F.count_if(F.col(similarity) >= 0.9 * F.col("__top")).alias("__many"))
    near_by = pairs.join(linked.select(event, F.col(record).alias("__own"), F.col(similarity).alias("__got")), event).where(F.col(record) != F.col("__own")).groupBy(event).agg(F.count_if(F.abs(F.col(similarity) - F.col("__got")) < near).alias("__near"))
    all_ = events.select(event).distinct().join(linked.select(event, F.col(similarity).alias("__got")), event, "left").join(close, event, "left").join(near_by, event, "left")
    reasons = F.array_compact(F.array(
        F.when(F.col("__got") < low, F.lit("low_similarity")), F.when(F.col("__got").isNotNull() & (F.col("__near") > 0), F.lit("near_tie")),
        F.when(F.col("__many") > many, F.lit("ambiguous")), F.when(F.col("__got").isNull(), F.lit("unlinked")),
    ))
    return all_.select(event, F.explode(reasons).alias("reason"), F.col("__got").alias(similarity))
