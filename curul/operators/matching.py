"""One-to-one assignment by order of preference, spread over all tasks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curul.plans.state import cut


def greedy_matching(pairs: DataFrame, left: list[str], right: list[str], preference: Column, best: Callable[[str], Column] = F.min) -> DataFrame:
    """The pairs that are taken when all are gone through in the order of ``preference``, each left and each right once.

    ``preference`` must tell all pairs apart; with ``best`` F.max it is gone through from the top. Each round takes the
    pairs that are the best of both their ends, which the walk through all pairs would take too, and drops the pairs of
    ends that are taken; two aggregations with map-side combine and four equi-joins a round, and no task needs more
    than its share. Rounds end when no pair is left. Nulls among the columns are values like others; repeated pairs
    count once.
    """
    side = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    p = cut(pairs.distinct().withColumns({"__p": preference, "__l": side(left), "__r": side(right)}))
    taken = []
    while True:
        top = lambda c, out: p.groupBy(c).agg(best("__p").alias(out))  # noqa: E731, B023
        take = cut(p.join(top("__l", "__pl"), "__l").join(top("__r", "__pr"), "__r").where("__p = __pl AND __p = __pr").drop("__pl", "__pr"))
        if take.isEmpty():
            break
        taken.append(take)
        p = cut(p.join(take.select("__l"), "__l", "left_anti").join(take.select("__r"), "__r", "left_anti"))
    return reduce(DataFrame.unionByName, taken or [take]).select(*pairs.columns)
