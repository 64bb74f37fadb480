import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from curul.llm.mixing import fit_cells, mix, rake, shares, tempered
from curul.llm.packing import fit_counts, pack, plan_by_patterns, plan_packing, usage
from curul.llm.tokens import TOKENIZER, encoding, token_count


@pytest.mark.parametrize("cap", [1, 7, 64, 512])
def test_plan_covers_every_item_once(cap):
    rng = np.random.default_rng(cap)
    for n in (0, 1, 50, 3000):
        hist = np.bincount(np.minimum(rng.lognormal(3, 1, n).astype(int) + 1, cap), minlength=cap + 1)
        seg, count = plan_packing(hist, cap)
        fill, seen = np.zeros(count, np.int64), np.zeros(cap + 1, np.int64)
        for v, a, b, at, each in seg:
            assert a == seen[v]
            seen[v] = b
            for r in range(a, b):
                fill[at + (r - a) // each] += v
        assert (seen[1:] == hist[1:]).all() and (count == 0 or fill.max() <= cap and fill.min() > 0)
        least = -(-int((hist * np.arange(cap + 1)).sum()) // cap)
        assert count <= max(least * 1.25 + 1, (hist[cap // 2 + 1 :]).sum() * 1.1 + least * 0.3 + 2)


@pytest.mark.parametrize(("low", "high", "cap"), [(90, 111, 2048), (1, 512, 512), (5, 1500, 8192), (100, 3000, 8192)])
def test_patterns_place_most(low, high, cap):
    """Whatever the ratio of lengths to the capacity, patterns place nine tenths and containers are nearly full."""
    hist = np.bincount(np.random.default_rng(low).integers(low, high, 20_000), minlength=cap + 1)
    _, count, share = plan_by_patterns(hist, cap)
    # containers cannot be fewer than tokens over capacity, nor than items over half of it
    least = max(-(-int((hist * np.arange(cap + 1)).sum()) // cap), int(hist[cap // 2 + 1 :].sum()))
    assert share >= 0.9 and count <= least * 1.02


def test_fit_is_the_least_squares_solution():
    hist = np.array([0, 4, 6, 2, 0, 3])
    x = fit_counts([(5,), (2, 3), (1, 2, 2), (1, 1, 3)], hist, 2000)
    a = np.zeros((6, 4))
    for j, p in enumerate([(5,), (2, 3), (1, 2, 2), (1, 1, 3)]):
        for v in p:
            a[v, j] += 1
    g = a.T @ (hist - a @ x)
    assert (x >= 0).all() and np.abs(g[x > 1e-6]).max() < 0.02 and (g <= 0.02).all()


def test_pack(spark):
    data = [(k, int(v), "x", k) for k, v in enumerate(np.random.default_rng(3).integers(1, 90, 400))] + [(900, 0, "", 0), (901, None, "", 0), (902, 730, "", 0)]
    df = spark.createDataFrame(data, "doc long, size int, length string, part int")
    p = pack(df, "doc", "size", {1: 100, 2: 64}).cache()
    assert p.where("container IS NULL").count() == 4
    for cap_id, cap in ((1, 100), (2, 64)):
        own = p.where(F.col("cupo_id") == cap_id)
        fill = own.where("container IS NOT NULL").groupBy("container").agg(F.sum(F.col("token_to") - F.col("token_from")).alias("t"))
        assert fill.agg(F.max("t")).first()[0] <= cap and fill.agg(F.max("container")).first()[0] + 1 == fill.count()
        per = {r.id: (r.n, r.t) for r in own.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col("token_to") - F.col("token_from")).alias("t")).collect()}
        assert per == {d: (max(1, -(-(s or 0) // cap)), s or 0) for d, s, *_ in data}
    assert usage(p, {1: 100, 2: 64}).where("share_used > 0.95").count() == 2
    assert pack(df.limit(0), "doc", "size", {1: 100}).count() == 0
    hot = pack(spark.range(9000).select("id", F.lit(33).alias("size")), "id", "size", {1: 100})
    assert hot.groupBy("container").count().where("count > 3").count() == 0 and hot.select("container").distinct().count() == 3000


def test_rake_meets_marginals():
    cells = pd.DataFrame([(s, v, t, 10 * k + 5) for k, (s, v, t) in enumerate((s, v, t) for s in "ab" for v in ("es", "en") for t in "12")], columns=["source", "language", "topic", "tokens"])
    w = rake(cells, {"source": {"a": 0.7, "b": 0.3}, "language": {"es": 0.5, "en": 0.5}, "topic": {"1": 0.4, "2": 0.6}})
    for col, target in (("source", {"a": 0.7, "b": 0.3}), ("language", {"es": 0.5, "en": 0.5}), ("topic", {"1": 0.4, "2": 0.6})):
        got = pd.Series(w).groupby(cells[col]).sum() / w.sum()
        assert all(abs(got[k] - v) < 1e-6 for k, v in target.items())


def test_mix(spark):
    n = 6000
    docs = spark.range(n).select("id", F.concat(F.lit("t"), (F.col("id") % 5500)).alias("text"), F.when(F.col("id") % 20 == 0, "rara").when(F.col("id") % 2 == 0, "grande").otherwise("media").alias("source"), F.when(F.col("id") % 7 == 0, None).otherwise("es").alias("lang"), (F.col("id") % 3).alias("topic"), (F.pmod(F.xxhash64("id"), F.lit(90)) + 10).alias("size"), F.lit(1).alias("copies"))
    weights, caps = {"rara": 0.3, "grande": 0.4, "media": 0.3, "ninguna": 0.0}, {"rara": 4, "grande": 1, "media": 2, "ninguna": 9}
    m = mix(docs, "id", "text", "size", "source", weights, caps, "lang", "topic").cache()
    s = {r.source: r for r in shares(m, spark.createDataFrame(list(weights.items()), "source string, w double"), "source", "w").collect()}
    for k, w in weights.items():
        assert abs(s[k].share - w) < 0.01 and s[k].most_copies <= caps[k]
    assert m.join(docs.select("id", "text"), "id").groupBy("text").agg(F.count("*").alias("n")).where("n > 1").count() == 0
    assert mix(docs.limit(0), "id", "text", "size", "source", weights, caps, "lang", "topic").count() == 0
    only = mix(docs, "id", "text", "size", "source", weights, caps, "lang", "topic", language_targets={"es": 0.5, "und": 0.5})
    got = {r.language: r.t for r in only.groupBy("language").agg(F.sum(F.col("size") * F.col("copies")).alias("t")).collect()}
    assert abs(got["es"] / sum(got.values()) - 0.5) < 0.03


def _cells(seed=0):
    rng = np.random.default_rng(seed)
    return pd.DataFrame([(s, v, t, int(rng.integers(20, 4000)), 1) for s in "abcd" for v in ("es", "en") for t in "12345"], columns=["source", "language", "topic", "tokens", "n"])


def test_raking_is_more_than_scaling():
    """With targets of their own for topics the fit moves probabilities inside a source, and all marginals are met."""
    cells, weights, caps = _cells(), {"a": 0.1, "b": 0.2, "c": 0.3, "d": 0.4}, {"a": 3, "b": 1, "c": 2, "d": 1}
    topics = tempered(0.5)((cells.groupby("topic").tokens.sum() / cells.tokens.sum()).to_dict())
    f = fit_cells(cells, {"source": weights, "topic": topics}, caps)
    w = f * cells.tokens
    plain = cells.source.map(weights) / cells.groupby("source").tokens.transform("sum")
    moved = (f / w.sum()) / plain
    assert moved.max() / moved.min() > 1.1
    assert (f >= 0).all() and (f <= cells.source.map(caps) + 1e-9).all()
    for col, t in (("source", weights), ("topic", topics)):
        got = w.groupby(cells[col]).sum() / w.sum()
        assert all(abs(got[k] - v / sum(t.values())) < 2e-3 for k, v in t.items())


def test_contradicting_targets_keep_the_sources():
    cells = pd.DataFrame([("a", "es", "1", 900, 1), ("b", "en", "1", 100, 1)], columns=["source", "language", "topic", "tokens", "n"])
    w = fit_cells(cells, {"source": {"a": 0.5, "b": 0.5}, "language": {"es": 0.9, "en": 0.1}}, {"a": 1, "b": 2}) * cells.tokens
    assert w[0] == pytest.approx(w[1]) and w[1] == pytest.approx(200)


def test_text_of_two_sources_goes_where_it_is_scarce(spark):
    rows = [(k, f"t{k}", "a", 10) for k in range(50)] + [(100 + k, f"t{k}", "b", 10) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, text string, source string, size int").withColumns({"lang": F.lit("es"), "topic": F.lit(1)})
    m = mix(df, "id", "text", "size", "source", {"a": 0.9, "b": 0.1}, {"a": 1, "b": 1}, "lang", "topic")
    got = {r.source: (r.n, r.m) for r in m.groupBy("source").agg(F.count("*").alias("n"), F.min("id").alias("m")).collect()}
    assert got["b"] == (5, 100) and got["a"][0] == 45


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no vocabulary here")
def test_tokens(spark):
    texts = ["Hola, congreso.", "", None, "palabra " * 20_000]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(token_count(F.col("t")).alias("n")).collect()]
    assert got == [len(encoding(TOKENIZER).encode_ordinary(t)) if t else 0 for t in texts]
