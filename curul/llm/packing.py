"""Filling containers of fixed capacity with whole items by pattern packing.

Lengths are bounded by the capacity, so the histogram of lengths, the patterns and the plan are bounded by it too,
however many items there are. The driver works in rounds: patterns (a few lengths that fill a container) are generated
from what the histogram still holds, their repeat counts are fitted to it by non-negative least squares, rounded and
taken off, and the next round generates patterns from the residual. What no pattern fills any more is packed by best
fit. The plan says, for each length, which run of its items goes to which containers; items are ranked within their
length in parallel, over hash ranges, and look their container up by rank.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curul.plans.state import cut

#: Items of one length are ranked apart in hash ranges of about so many.
RANGE_ITEMS = 100_000
#: Patterns generated in one round; rounds go on until no pattern fills a container.
PATTERNS_A_ROUND = 4000
#: Rounds go on until this share of the capacity must stay free in every pattern found.
MOST_FREE = 1 / 128


def generate_patterns(left: np.ndarray, capacity: int, many: int, free: int, rng: np.random.Generator) -> list[tuple[int, ...]]:
    """Up to ``many`` different patterns of lengths that ``left`` holds, each leaving at most ``free`` of the capacity.

    A pattern begins with lengths drawn as often as they are left, so patterns use up the histogram evenly; one or two
    lengths of which most are left complete it exactly, or as nearly as they can.
    """
    present = np.flatnonzero(left[: capacity + 1] > 0)
    present = present[present > 0]
    if not len(present):
        return []
    out: dict[tuple[int, ...], None] = {}
    weight = left[present].astype(np.float64)
    typical = 2 * int((present * weight).sum() / weight.sum())
    least = int(present[0])
    w = np.zeros(capacity + 1)
    w[present] = weight
    steps = np.cumsum(weight)
    steps /= steps[-1]
    # long lengths are the hard ones to place: the first of a pattern is drawn by count times length squared
    heads = np.cumsum(weight * present.astype(np.float64) ** 2)
    heads /= heads[-1]
    for _ in range(many):
        room, items, used = capacity, [], w
        draws = rng.random(min(64, capacity // least + 1))
        for v in present[np.append(np.searchsorted(heads, draws[:1]), np.searchsorted(steps, draws[1:]))].tolist():
            if items and room <= typical:
                break
            if v <= room:
                if items and used is w:
                    used = w.copy()
                if used is not w and used[v] < 1:
                    continue
                items.append(v)
                if used is not w:
                    used[v] -= 1
                room -= v
        if items and used is w:
            used = w.copy()
            used[items[0]] -= 1
        for _ in range(4):  # one length, then two, for all the room; then a little less
            if room < least:
                break
            single = used[: room + 1]
            both = np.minimum(single, single[::-1])
            if room % 2 == 0 and used[room // 2] < 2:
                both[room // 2] = 0
            if single[room] > 0 and rng.random() * (single[room] + both.max()) < single[room]:
                items.append(room)
                room = 0
                break
            if both.max() > 0:
                # of the pairs that fill the room, one of those with most left, at random
                ok = np.flatnonzero(both >= 0.5 * both.max())
                v = int(ok[rng.integers(len(ok))])
                items += [v, room - v]
                room = 0
                break
            fits = present[: np.searchsorted(present, room, side="right")]
            fits = fits[used[fits] > 0]
            if not len(fits):
                break
            v = int(fits[-1] if room - fits[-1] <= free or room < 3 * least else fits[rng.integers(len(fits))])
            used = used.copy() if used is w else used
            used[v] -= 1
            items.append(v)
            room -= v
        if items and room <= free:
            out[tuple(sorted(items, reverse=True))] = None
    return list(out)


def fit_counts(patterns: list[tuple[int, ...]], hist: np.ndarray, steps: int = 200) -> np.ndarray:
    """Repeat counts x >= 0 with least squared error of (uses of each length - items of it), relative to the items: by
    accelerated projected gradient on the sparse matrix of patterns."""
    if not patterns:
        return np.zeros(0)
    row = np.concatenate([np.asarray(p) for p in patterns])
    col = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    scale = 1.0 / np.sqrt(np.maximum(hist, 1.0))
    b = hist * scale
    s = scale[row]
    s = s / np.sqrt(np.bincount(col, s * s, len(patterns)))[col]  # columns of one length, so that hot lengths settle as soon as rare ones
    times = lambda x: np.bincount(row, s * x[col], len(hist))
    back = lambda r: np.bincount(col, s * r[row], len(patterns))
    v = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue gives the step
        v = back(times(v))
        norm = np.linalg.norm(v)
        if not norm:
            return np.zeros(len(patterns))
        v /= norm
    step = 0.9 / norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y + step * back(b - times(y)))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x / np.sqrt(np.bincount(col, scale[row] ** 2, len(patterns)))


def plan_packing(hist: np.ndarray, capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(segments, containers) of ``plan_by_patterns``."""
    return plan_by_patterns(hist, capacity)[:2]


def plan_by_patterns(hist: np.ndarray, capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int, float]:
    """(segments, containers, share of the tokens placed by patterns). A segment (length, first, last, container, each):
    items of that length ranked first..last-1 go to containers container, container + 1, ..., each taking ``each`` of
    them. All items are covered exactly once. The same histogram gives the same plan."""
    left = hist.astype(np.int64).copy()
    lengths = np.arange(len(left))
    tokens = int((left * lengths).sum())
    groups: list[tuple[dict[int, int], int]] = []  # (items of each length in one container, containers)
    rng, free, idle = np.random.default_rng(capacity), 0, 0
    if left[capacity]:
        groups.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    while (rest := int((left * lengths).sum())) >= capacity and free <= capacity * MOST_FREE:
        patterns = generate_patterns(left, capacity, int(np.clip(rest / capacity, 64, PATTERNS_A_ROUND)), free, rng)
        x = fit_counts(patterns, left)
        placed = 0
        for j in np.argsort(-x, kind="stable").tolist():
            if x[j] < 0.2:
                break
            need = Counter(patterns[j])
            k = min(max(1, int(x[j])), *(int(left[v]) // c for v, c in need.items()))
            if k > 0:
                groups.append((dict(need), k))
                placed += k * sum(patterns[j])
                for v, c in need.items():
                    left[v] -= c * k
        # where exact fills have become rare, a little more may stay free
        idle = idle + 1 if placed < 0.1 * rest else 0
        if not placed or idle > 2:
            free, idle = max(1, 2 * free), 0
    by_patterns = 1 - int((left * lengths).sum()) / max(1, tokens)
    # what rounding left: longest first, each into the fullest open container that takes it
    opened: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for v in range(capacity, 0, -1):
        n = int(left[v])
        for room in sorted(k for k in opened if k >= v):
            if not n:
                break
            todo, opened[room] = opened[room], []
            while todo:
                items, k = todo.pop()
                if not n:
                    opened[room].append((items, k))
                    continue
                m = room // v
                full = min(k, n // m)
                if full:
                    opened[room - m * v].append(({**items, v: items.get(v, 0) + m}, full))
                    n -= m * full
                    k -= full
                if k and 0 < n < m:
                    opened[room - n * v].append(({**items, v: items.get(v, 0) + n}, 1))
                    n, k = 0, k - 1
                if k:
                    opened[room].append((items, k))
        if n:
            m = capacity // v
            if n // m:
                opened[capacity - m * v].append(({v: m}, n // m))
            if n % m:
                opened[capacity - (n % m) * v].append(({v: n % m}, 1))
    groups += [g for gs in opened.values() for g in gs]
    at, rank, out = 0, defaultdict(int), []
    for items, k in groups:
        for v, c in sorted(items.items()):
            out.append((v, rank[v], rank[v] + c * k, at, c))
            rank[v] += c * k
        at += k
    return out, at, by_patterns


def ranked(items: DataFrame, keys: list[str], order: list[str], salts: int) -> DataFrame:
    """Adds ``rank`` from 0 within the keys, in parallel: counts of ``salts`` hash ranges give each range its start."""
    h = F.xxhash64(*order)
    s = items.withColumns({"__h": h, "__s": F.pmod(h, F.lit(salts)).cast("int")})
    counts = s.groupBy(*keys, "__s").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("__start", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy(*keys, "__s").orderBy("__h", *order)) - 1
    return s.withColumn("__r", own).join(start, [*keys, "__s"]).withColumn("rank", F.col("__start") + F.col("__r")).drop("__h", "__s", "__r", "__start")


def pack(items: DataFrame, id_col: str, size_col: str, capacities: dict[int, int]) -> DataFrame:
    """(cupo_id, container, id, part, token_from, token_to): every item in one container of each capacity.

    An item longer than a capacity is divided into full containers and a rest, which is packed like an item; no other
    item is divided. Items of size 0 or null take no room: one row with null container and part 0, token_to 0.
    Containers are numbered from 0 for each capacity. ``capacities`` maps an id to a capacity >= 1; the driver holds
    one histogram of at most the capacity's length for each.
    """
    if any(c < 1 for c in capacities.values()):
        raise ValueError("capacities must be at least 1")
    spark = items.sparkSession
    # sizes are counted once; two numbers an item are kept
    base = cut(items.select(F.col(id_col).alias("id"), F.coalesce(F.col(size_col), F.lit(0)).cast("bigint").alias("size")))
    cap = F.array(*[F.struct(F.lit(k).cast("bigint").alias("cupo_id"), F.lit(c).cast("bigint").alias("cap")) for k, c in capacities.items()])
    each = base.select("id", "size", F.explode(cap).alias("c")).select("id", "size", "c.*")
    parts = F.greatest(F.lit(1), F.expr("(size + cap - 1) div cap"))
    piece = each.where("size > 0").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    piece = piece.select("cupo_id", "id", "part", (F.col("part") * F.col("cap")).alias("token_from"), F.least(F.col("size"), (F.col("part") + 1) * F.col("cap")).alias("token_to"))
    piece = piece.withColumn("length", F.col("token_to") - F.col("token_from"))
    counts = piece.groupBy("cupo_id", "length").agg(F.count("*").alias("n")).toPandas()
    plans = {}
    for k, c in capacities.items():
        own = counts[counts.cupo_id == k]
        hist = np.zeros(c + 1, np.int64)
        hist[own.length.to_numpy(np.int64)] = own.n.to_numpy(np.int64)
        seg, _ = plan_packing(hist, c)
        by: dict[int, list] = defaultdict(list)
        for v, a, b, at, m in seg:
            by[v].append((a, at, m))
        plans[k] = {v: np.array(sorted(x), np.int64) for v, x in by.items()}
    shared = spark.sparkContext.broadcast(plans)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        for b in batches:
            container = np.zeros(len(b), np.int64)
            where = b.groupby(["cupo_id", "length"]).indices
            for (k, v), at in where.items():
                seg = plan[k][v]
                r = b["rank"].to_numpy()[at]
                s = seg[np.searchsorted(seg[:, 0], r, side="right") - 1]
                container[at] = s[:, 1] + (r - s[:, 0]) // s[:, 2]
            yield b.assign(container=container)[["cupo_id", "container", "id", "part", "token_from", "token_to"]]

    id_type = base.schema["id"].dataType.simpleString()
    r = ranked(piece, ["cupo_id", "length"], ["id", "part"], 1 + int(counts["n"].max() if len(counts) else 0) // RANGE_ITEMS)
    placed = r.select("cupo_id", "length", "rank", "id", "part", "token_from", "token_to").mapInPandas(place, f"cupo_id bigint, container bigint, id {id_type}, part bigint, token_from bigint, token_to bigint")
    none = each.where("size <= 0").select("cupo_id", F.lit(None).cast("bigint").alias("container"), "id", *[F.lit(0).cast("bigint").alias(c) for c in ("part", "token_from", "token_to")])
    return placed.unionByName(none)


def usage(packed: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """(cupo_id, capacity, containers, tokens, share_used): how full the containers are."""
    cap = F.element_at(F.create_map(*[x for k, c in capacities.items() for x in (F.lit(k).cast("bigint"), F.lit(c).cast("bigint"))]), F.col("cupo_id"))
    per = packed.where("container IS NOT NULL").groupBy("cupo_id", "container").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("t"))
    u = per.groupBy("cupo_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    return u.withColumn("capacity", cap).withColumn("share_used", F.col("tokens") / (F.col("containers") * F.col("capacity")))
