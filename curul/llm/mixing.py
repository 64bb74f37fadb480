"""Mixing sources to target weights by iterative proportional fitting and calibrated sampling.

The corpus is counted into cells of source, language and topic, whose number doesn't grow with the corpus. The driver
rakes the cells' token weights to the marginals, none beyond its cap: what a capped cell can't give, the other cells of
the marginal's value give. A cell's weight over its tokens is the number of times each of its texts should be used.
The whole part is taken as it is; the rest is the probability of one more use. Texts are drawn by order sampling with
these probabilities until their source's tokens are reached, so each source is within one text of its target.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curul.plans.state import cut

#: Ranges of the sampling order whose token sums are added up first, so no task reads a whole source.
RANGES = 512
#: More cells than this raise instead of being collected.
MOST_CELLS = 100_000


def rake(cells: pd.DataFrame, targets: dict[str, dict], total: float | None = None, most: np.ndarray | None = None, rounds: int = 300, tolerance: float = 1e-9) -> np.ndarray:
    """Weights of the cells (columns of the targets, and tokens) after fitting each marginal in turn, the first one last.

    A marginal's shares are relative; values it doesn't name keep their weight relative to their present sum. Values
    without tokens can't be met and are left out. ``total`` is the sum of the weights (that of the tokens unless given);
    with ``most`` no weight exceeds its bound, and cells below theirs make up for it as far as they can.
    """
    tokens = cells["tokens"].to_numpy(np.float64)
    total = float(tokens.sum()) if total is None else total
    most = np.full(len(cells), np.inf) if most is None else most
    w = np.minimum(tokens * (total / max(tokens.sum(), 1e-300)), most)
    marginals = []
    for col in [*list(targets)[1:], next(iter(targets))]:
        code, values = pd.factorize(cells[col], use_na_sentinel=False)
        share = np.array([targets[col].get(v, np.nan) if v == v else np.nan for v in values], np.float64)
        have = np.bincount(code, tokens, len(values)) > 0
        marginals.append((code, np.where(have, share, np.nan)))
    for _ in range(rounds):
        before = w.copy()
        for code, share in marginals:
            named = ~np.isnan(share)
            sums = np.bincount(code, w, len(share))
            if not named.any() or np.nansum(share) <= 0:
                continue
            aim = np.where(named, share / np.nansum(share) * max(0.0, total - sums[~named].sum()), sums)
            full = np.zeros(len(w), bool)
            for _ in range(60):
                free = np.bincount(code, np.where(full, 0.0, w), len(share))
                rest = np.maximum(0.0, aim - np.bincount(code, np.where(full, np.where(np.isinf(most), 0.0, most), 0.0), len(share)))
                f = np.divide(rest, free, out=np.zeros_like(rest), where=free > 0)
                over = ~full & (w * f[code] > most)
                if not over.any():
                    break
                full |= over
            w = np.where(full, most, w * f[code])
        if np.abs(w - before).max(initial=0.0) <= tolerance * max(total, 1):
            break
    return w


def _miss(cells: pd.DataFrame, w: np.ndarray, targets: dict[str, dict], total: float) -> float:
    """The largest difference between a share aimed at and the share reached, of the values that have tokens."""
    worst = 0.0
    for col, aims in targets.items():
        got, have = pd.Series(w).groupby(cells[col].to_numpy()).sum(), cells.groupby(col)["tokens"].sum()
        known = {k: v for k, v in aims.items() if have.get(k, 0) > 0}
        named = sum(got.get(k, 0.0) for k in known) if len(known) < len(have) else total
        s = sum(known.values())
        worst = max([worst, *[abs(got.get(k, 0.0) - v / s * named) / total for k, v in known.items() if s > 0]])
    return worst


def fit_cells(cells: pd.DataFrame, targets: dict[str, dict], caps: dict, tolerance: float = 1e-3) -> np.ndarray:
    """Uses of the texts of each cell (0 to its source's cap): weights raked to the targets over the cells' tokens.

    The total is the largest at which every marginal is met within ``tolerance``. Where no total meets them all (the
    targets contradict one another) it is the largest that the sources can give, and the first marginal, the sources,
    is met while the others are as near as raking brings them.
    """
    tokens = cells["tokens"].to_numpy(np.float64)
    col, weights = next(iter(targets.items()))
    most = tokens * cells[col].map(caps).to_numpy(np.float64)
    can, s = pd.Series(most).groupby(cells[col].to_numpy()).sum(), sum(weights[k] for k in set(cells[col]))
    high = min(can[k] / (weights[k] / s) for k in can.index if weights[k] > 0)
    best = w = rake(cells, targets, high, most)
    if _miss(cells, w, targets, high) > tolerance:
        low, found = 0.0, None
        for _ in range(14):
            middle = (low + high) / 2
            w = rake(cells, targets, middle, most)
            if _miss(cells, w, targets, middle) <= tolerance:
                low, found = middle, w
            else:
                high = middle
        best = best if found is None else found
    return np.minimum(best / tokens, most / tokens)


def tempered(power: float) -> Callable[[dict], dict]:
    """Targets from the corpus's own shares: each raised to ``power``, so that values below 1 flatten them."""
    return lambda shares: {k: v**power for k, v in shares.items()}


def mix(texts: DataFrame, id_col: str, text_col: str, size_col: str, source_col: str, weights: dict[str, float], caps: dict[str, int], language_col: str, topic_col: str, language_targets: dict | Callable[[dict], dict] | None = None, topic_targets: dict | Callable[[dict], dict] | None = None) -> DataFrame:
    """(id, source, language, topic, size, copies) of every text used at least once.

    A text that occurs under several ids is used through one of them, so no text exceeds its source's cap: through the
    source that has least for its weight, there through its smallest id. Targets for language and topic are shares, or a
    function from the corpus's shares to shares; without them their marginals are those that the sources' weights imply.
    For the total see ``fit_cells``. Sources without a weight, null sources and texts of size 0 or null are not used.
    """
    base = texts.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.col(language_col), F.lit("und")).alias("language"), F.coalesce(F.col(topic_col).cast("string"), F.lit("-")).alias("topic"), F.col(size_col).cast("bigint").alias("size"), F.xxhash64(text_col).alias("k1"), F.sha2(F.col(text_col), 256).substr(1, 16).alias("k2"))
    base = base.where(F.col("size") > 0)
    base = base.where(F.col("source").isin([s for s, w in weights.items() if w > 0]))
    own = cut(base.groupBy("k1", "k2", "source").agg(F.min(F.struct("id", "language", "topic", "size")).alias("f")).select("k1", "k2", "source", "f.*"))
    spark = texts.sparkSession
    # how often a source could give its weight: one row a source
    supply = {r["source"]: float(r["t"]) * caps[r["source"]] / weights[r["source"]] for r in own.groupBy("source").agg(F.sum("size").alias("t")).collect()}
    plenty = spark.createDataFrame(sorted(supply.items()), "source string, plenty double")
    one = own.join(F.broadcast(plenty), "source").groupBy("k1", "k2").agg(F.min(F.struct("plenty", "id", "source", "language", "topic", "size")).alias("f"))
    used = cut(one.select("f.*").drop("plenty"))
    cells = used.groupBy("source", "language", "topic").agg(F.sum("size").alias("tokens"), F.count("*").alias("n")).limit(MOST_CELLS + 1).toPandas()
    if len(cells) > MOST_CELLS:
        raise ValueError(f"over {MOST_CELLS} cells of source, language and topic")
    schema = "source string, language string, topic string, whole int, p double"
    plan = spark.createDataFrame([], schema)
    if len(cells):
        cells = cells.sort_values(["source", "language", "topic"]).reset_index(drop=True)
        targets: dict[str, dict] = {"source": weights}
        implied = cells.assign(w=cells.tokens / cells.groupby("source").tokens.transform("sum") * cells.source.map(weights))
        for col, given in (("language", language_targets), ("topic", topic_targets)):
            corpus = (cells.groupby(col).tokens.sum() / cells.tokens.sum()).to_dict()
            targets[col] = given(corpus) if callable(given) else given or implied.groupby(col).w.sum().to_dict()
        f = fit_cells(cells, targets, caps)
        whole = np.floor(f + 1e-9)
        p = np.where(f - whole > 1e-9, f - whole, 0.0)
        plan = spark.createDataFrame(list(zip(cells.source, cells.language, cells.topic, whole.astype(int).tolist(), p.tolist())), schema)
    keys = ["source", "language", "topic"]
    # plan has at most MOST_CELLS rows of three short strings and two numbers
    t = used.join(F.broadcast(plan), keys)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "id"), 11).cast("double") + 0.5) / 2.0**53
    # order sampling: a text's number over its probability; its source takes the lowest until its tokens are reached
    t = t.withColumn("x", F.when(F.col("p") > 0, u / F.col("p")).otherwise(F.lit(float("inf"))))
    t = t.withColumn("range", F.least(F.lit(4 * RANGES), F.floor(F.col("x") * RANGES)).cast("int"))
    aims = t.groupBy("source", "range").agg(F.sum("size").alias("t"), F.sum(F.col("p") * F.col("size")).alias("a"))
    w = Window.partitionBy("source")
    before = aims.select("source", "range", F.coalesce(F.sum("t").over(w.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"), F.sum("a").over(w).alias("aim"))
    placed = t.join(before, ["source", "range"])
    # Only ranges that begin before the aim can be taken from; they are even parts of the texts drawn. What lies beyond,
    # most of a large source, needs no order.
    open_range = (F.col("p") > 0) & (F.col("start") < F.col("aim"))
    inside = F.sum("size").over(Window.partitionBy("source", "range").orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    # a text is taken when its middle lies within the tokens aimed at
    drawn = placed.where(open_range).withColumn("extra", (F.col("start") + inside + F.col("size") / 2 <= F.col("aim")).cast("int"))
    rest = placed.where(~open_range & (F.col("whole") > 0)).withColumn("extra", F.lit(0))
    return drawn.unionByName(rest).withColumn("copies", F.col("whole") + F.col("extra")).where("copies > 0").select("id", *keys, "size", "copies")


def shares(mixed: DataFrame, targets: DataFrame, source_col: str, weight_col: str) -> DataFrame:
    """(source, target, tokens, share, texts, most_copies), one row per source of the targets, met or not."""
    got = mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("tokens"), F.count("*").alias("texts"), F.max("copies").alias("most_copies"))
    t = targets.select(F.col(source_col).alias("source"), F.col(weight_col).alias("target")).join(got, "source", "left")
    total = got.agg(F.sum("tokens").alias("all_tokens"))
    return t.join(F.broadcast(total)).select("source", "target", F.coalesce("tokens", F.lit(0)).alias("tokens"), (F.coalesce("tokens", F.lit(0)) / F.col("all_tokens")).alias("share"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
