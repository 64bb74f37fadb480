"""Connected components by alternating large and small stars, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curul.plans.state import cut


def _min_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(links: DataFrame, a: str, b: str, most_rounds: int = 40) -> DataFrame:
    """(node, component): the component is its smallest node; only nodes that have a link appear.

    Null ends and loops are ignored. Each round is two aggregations with map-side combine and two equi-joins;
    a round's links are cut from their lineage by a checkpoint. Raises if it has not settled after ``most_rounds``.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_min_neighbour(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*").where("u <> v").distinct()
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    own = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return own.unionByName(own.select(F.col("component").alias("node"), "component").distinct())
