import itertools
import random
import time
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from curul.functions.text import words
from curul.llm import near_duplicates
from curul.llm.near_duplicates import bucket_pairs, min_max_signature, near_duplicate_classes, near_duplicate_pairs, word_set
from curul.plans.state import shared_folder


def make(rng, n=120):
    stock = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(n):
        texts.append(" ".join(["de", "la", "ley", *rng.sample(stock, 20)]))
    for _ in range(n):
        t = rng.choice(texts).split()
        for _ in range(rng.randrange(6)):
            t[rng.randrange(len(t))] = rng.choice(stock)
        rng.shuffle(t)
        texts.append(" ".join(t))
    return texts


def brute(spark, df, limit, least):
    sets = {r.id: set(r.w) for r in df.where("id IS NOT NULL").select("id", words("text").alias("w")).collect() if len(r.w) >= least}
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]) - 1e-12}


def test_all_pairs_against_brute_force(spark):
    texts = make(random.Random(5)) + [None, "", "pocas palabras", "Ñandú árbol uno dos tres cuatro cinco seis siete", "nandu ARBOL uno, dos; tres cuatro cinco seis siete!"]
    texts += [texts[0]] * 3
    data = [(k, t, "x", k % 3) for k, t in enumerate(texts)]
    df = spark.createDataFrame(data, "id long, text string, words string, rep int")
    got = [(r.id_a, r.id_b) for r in near_duplicate_pairs(df, "id", "text", 0.65).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(spark, df, 0.65, 8)


def test_classes(spark):
    texts = make(random.Random(6), 40) + [None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string")
    pairs = brute(spark, df, 0.65, 8)
    root = {k: k for k in range(len(texts))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.id: r.class_id for r in near_duplicate_classes(df, "id", "text", 0.65).collect()}
    assert got == {k: find(k) for k in range(len(texts))}


def test_group_of_a_third(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("a b c d e f g h i j")).otherwise(F.concat_ws(" ", *[F.concat(F.lit(f"v{k}x"), F.col("id")) for k in range(10)])).alias("text"))
    c = near_duplicate_classes(df, "id", "text", 0.8)
    assert c.groupBy("class_id").count().agg(F.max("count")).first()[0] == 1000 and c.count() == 3000


def test_empty_and_long(spark):
    df = spark.createDataFrame([(1, " ".join(f"p{k}" for k in range(20_000))), (2, " ".join(f"p{k}" for k in range(19_500)))], "id long, text string")
    assert near_duplicate_pairs(df.limit(0), "id", "text", 0.65).count() == 0
    assert [(r.id_a, r.id_b) for r in near_duplicate_pairs(df, "id", "text", 0.65).collect()] == [(1, 2)]


def test_share_of_equal_values_is_the_weighted_similarity():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 60, 60).astype(np.uint64), rng.integers(0, 1 << 60, 20).astype(np.uint64)
    x, y = np.concatenate([a, b[:10]]), np.concatenate([a, b[10:]])
    k, s = min_max_signature([x, y, x], np.array([], np.uint64), np.array([]), 5.0, bands=4000, rows=1)
    assert (k[0] == k[1]).mean() == pytest.approx(60 / 80, abs=0.03)
    assert s[0] == s[2] and bin(int(s[0] ^ s[1])).count("1") < 24


def test_hot_bucket_is_split_and_whole(spark):
    band = spark.range(0, 60).selectExpr("id", "0L AS sketch", "CASE WHEN id < 50 THEN 1L ELSE id END AS key").unionByName(spark.range(10, 12).selectExpr("id", "0L AS sketch", "77L AS key"))
    got = [(r.a, r.b) for r in bucket_pairs(band, block=7).collect()]
    assert len(got) == len(set(got)) and set(got) == set(itertools.combinations(range(50), 2))
    far = band.withColumn("sketch", F.when(F.col("id") < 25, 0).otherwise(-1).cast("bigint"))
    assert set((r.a, r.b) for r in bucket_pairs(far, block=7).collect()) == set(itertools.combinations(range(25), 2)) | set(itertools.combinations(range(25, 50), 2))
    assert bucket_pairs(band, block=100).count() == 50 * 49 // 2


def test_words_as_the_engine_has_them(spark):
    texts = ["Ñandú ÁRBOL uno", "a\u0301b ½ x² ٣ﬁn", "", "İstanbul naïve—señal_z 42a", "Ωμέγα"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, t string")
    assert {r.id: sorted(r.w) for r in df.select("id", words("t").alias("w")).collect()} == {k: word_set(t) for k, t in enumerate(texts)}


def test_recall_on_random_edits(spark):
    """Numbers of edits drawn evenly, up to the limit itself: the shares found are printed."""
    rng = random.Random(11)
    stock = [f"x{k}" for k in range(30_000)]
    head = [f"h{k}" for k in range(12)]
    texts, true, clear = [], set(), set()
    for k in range(1500):
        w = head[: rng.randrange(6, 12)] + rng.sample(stock, 36)
        m = rng.randrange(0, 10)
        texts += [" ".join(w), " ".join(w[: len(w) - m] + rng.sample(stock, m))]
        a, b = set(texts[-2].split()), set(texts[-1].split())
        if a != b and len(a & b) / len(a | b) >= 0.65:
            true.add((2 * k, 2 * k + 1))
            if len(a & b) / len(a | b) >= 0.7:
                clear.add((2 * k, 2 * k + 1))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.id_a, r.id_b) for r in near_duplicate_pairs(df, "id", "text", 0.65).collect()}
    print("recall from 0.65", len(got & true) / len(true), "of", len(true), "from 0.7", len(got & clear) / len(clear), "of", len(clear))
    assert len(got & true) >= 0.997 * len(true) and len(got & clear) >= 0.999 * len(clear)


def test_disk_holds_one_round(spark, monkeypatch):
    """Bands in many rounds give the same pairs; shuffle files and tables that were read to the end are gone afterwards."""
    texts = make(random.Random(8), 60)
    texts += [f"{' '.join(texts[0].split()[:-1])} z{k}" for k in range(40)]  # more than a block of one bucket
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    monkeypatch.setattr(near_duplicates, "ROUND_ROWS", 2_500, raising=False)
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    files = lambda: {f.getPath() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    tables = lambda: set(Path(urlparse(shared_folder(spark)).path).glob("table-*"))
    shuffles, stored = files(), tables()
    pairs = near_duplicate_pairs(df, "id", "text", 0.65)
    until = time.time() + 10
    while (left := files() - shuffles) and time.time() < until:
        time.sleep(0.2)
    assert not left
    columns = [set(spark.read.parquet(str(t)).columns) for t in tables() - stored]
    assert columns and not [c for c in columns if "r0" in c or {"id", "words"} <= c]
    assert {(r.id_a, r.id_b) for r in pairs.collect()} == brute(spark, df, 0.65, 8)
