"""Near-duplicate records by weighted min-max hashing.

Every permutation gives two signature values: the word that comes first and the word that comes last under it, so a
signature of 2P values costs P hash evaluations. Words that many records have weigh less (an exponential race in place
of a plain permutation): the chance that two records share a value is their weighted similarity, which stays high for
edited copies and near zero for records that only share the phrases all records have.

Bands of values propose pairs; one bit of each of 64 further uses of the values, carried beside the band keys, turns
away most pairs that merely met by chance; bit maps of the word sets, which bound the similarity from above, turn away
nearly all others; the plain Jaccard similarity of the whole word sets decides. Each record is signed once and its
band keys are shuffled once, a few bands a round, so that the disk holds one round's keys and not all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curul.functions.text import ACCENTED, UNACCENTED
from curul.operators.components import connected_components
from curul.plans.state import cut, discard, shuffles_freed, stored

#: Bands of ROWS values each; BANDS * ROWS values need half as many permutations. With five values to a band the pairs
#: that unrelated records add are as many as the true ones at some hundred thousand records of the kind measured here;
#: the sketch turns most of them away. Collections of billions want more values to a band, and more bands.
BANDS, ROWS = 60, 5
#: A word weighs minus the logarithm of the share of records that have it, LEAST_WEIGHT at least; all words below this
#: share weigh the same. Words at or above it are sent to the workers.
COMMON_SHARE, LEAST_WEIGHT = 0.15, 0.25
#: Records added in thought when taking shares, so that words of a handful of records don't count as common. Beyond some
#: ten thousand records it no longer shows, and weights depend on the shares alone, whatever the size.
PRIOR_RECORDS = 1000
#: A common word also makes up at least this part of all word occurrences, so there are never more common words than
#: this. It matters only where records have over 2,000 words on average (MOST_COMMON * COMMON_SHARE).
MOST_COMMON = 20_000
#: Of 64 sketch bits, those that must agree: unrelated records agree in 34 give or take 4, similar ones in 50 or more.
SKETCH_AGREE = 42
#: Records of one bucket that are paired within one row; larger buckets are split into blocks of so many.
BLOCK = 256
#: Rows that one round shuffles at most, or a twelfth of all band keys where that is more.
ROUND_ROWS, MOST_PARTS = 4_000_000, 32

_ASCII_WORD, _WORD, _MARKS = re.compile(r"[a-z0-9]+"), regex.compile(r"[\p{L}\p{Nd}]+"), regex.compile(r"\p{M}+")
_PLAIN = str.maketrans(ACCENTED, UNACCENTED)
_FREQUENT = [(a, b) for a, b in zip(ACCENTED, UNACCENTED) if a in "áéíóúñü"]


def word_set(text: str) -> list[str]:
    """The distinct runs of letters and digits of a text in lower case without accents, sorted."""
    t = text.lower()
    if not t.isascii():
        for a, b in _FREQUENT:
            t = t.replace(a, b)
        if not t.isascii():
            t = _MARKS.sub("", t.translate(_PLAIN))
    return sorted(set((_ASCII_WORD if t.isascii() else _WORD).findall(t)))


@lru_cache(maxsize=1_000_000)
def word_id(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


@lru_cache(maxsize=1_000_000)
def _word_bit(word: str) -> int:
    return 1 << (word_id(word) & 127)


def bit_map(words: list[str]) -> tuple[int, int]:
    """128 bits as two signed numbers, of which each word sets one."""
    m = 0
    for w in words:
        m |= _word_bit(w)
    return tuple(x - (1 << 64) if x >> 63 else x for x in (m & (1 << 64) - 1, m >> 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def min_max_signature(word_ids: list[np.ndarray], common_ids: np.ndarray, common_weights: np.ndarray, rare_weight: float, bands: int = BANDS, rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, 64 sketch bits) of records, none of them empty. Word ids are uint64; ``common_ids`` sorted."""
    sizes = np.fromiter((len(w) for w in word_ids), np.int64, len(word_ids))
    flat = np.concatenate(word_ids)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    vocab, where = np.unique(flat, return_inverse=True)
    weight = np.full(len(vocab), rare_weight)
    if len(common_ids):
        at = np.minimum(np.searchsorted(common_ids, vocab), len(common_ids) - 1)
        hit = common_ids[at] == vocab
        weight[hit] = common_weights[at[hit]]
    n = len(word_ids)
    keys, sketch = np.empty((n, bands), np.uint64), np.zeros(n, np.uint64)
    key, in_key, band, used = np.full(n, 1, np.uint64), 0, 0, 0
    with np.errstate(over="ignore"):
        for p in range(max((bands * rows + 1) // 2, 32)):
            u = (_mix(vocab + np.uint64(0x9E3779B97F4A7C15) * np.uint64(p + 1)) >> np.uint64(11)).astype(np.float64)
            u = (u + 0.5) / 2.0**53
            for race in (-np.log(u) / weight, -np.log1p(-u) / weight):
                # bits of positive numbers are in their order, and whole numbers have their least found sooner
                v = np.minimum.reduceat(race.astype(np.float32).view(np.uint32)[where], starts).astype(np.uint64)
                if used < 64:
                    sketch |= (_mix(v) & np.uint64(1)) << np.uint64(used)
                used += 1
                if band < bands:
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + v)
                    in_key += 1
                    if in_key == rows:
                        keys[:, band] = key
                        band += 1
                        key, in_key = np.full(n, band + 1, np.uint64), 0
    return keys, sketch


def _agree(a: str | Column, b: str | Column) -> Column:
    return F.lit(64) - F.bit_count((F.col(a) if isinstance(a, str) else a).bitwiseXOR(F.col(b) if isinstance(b, str) else b))


def _parts(df: DataFrame, by: str, rows: int, most: int) -> list[DataFrame]:
    """The rows in parts of about ``most`` of their ``rows``, at most MOST_PARTS as each part reads them all; those of one
    value are in one part."""
    k = min(MOST_PARTS, -(-rows // most))
    return [df] if k < 2 else [df.where(F.pmod(F.xxhash64(by), F.lit(k)) == g) for g in range(k)]


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def _may_reach(threshold: float) -> Column:
    """Whether word sets of n1 and n2 words with maps (p1, q1) and (p2, q2) can be as similar as that: bits of one map that
    the other lacks are words it lacks, so the common words are at most the rest."""
    lacks = lambda x, y: F.bit_count(F.col(f"p{x}").bitwiseAND(F.bitwise_not(f"p{y}"))) + F.bit_count(F.col(f"q{x}").bitwiseAND(F.bitwise_not(f"q{y}")))
    most = F.least(F.col("n1") - lacks(1, 2), F.col("n2") - lacks(2, 1))
    return most >= threshold * (F.col("n1") + F.col("n2") - most)


def bucket_pairs(bands: DataFrame | Sequence[DataFrame], block: int = BLOCK, maps: DataFrame | None = None, threshold: float = 0.0, most: int = ROUND_ROWS) -> DataFrame:
    """(a, b), a < b, each pair of ids (column ``id``) once that meet under a ``key`` and whose ``sketch`` bits agree; with
    ``maps`` (id, n, p, q: number of words and bit map), only those whose similarity may reach the threshold.

    One shuffle brings the ids of a key together. A bucket of up to ``block`` ids is paired as its rows pass by; the rows
    of a larger one are split into blocks, and each block is joined with the later rows, so no task has a whole hot
    bucket's pairs and none are dropped. Tables of bands (no key in two of them) are taken one after the other, and
    what comes of them in parts of about ``most`` rows: each is a job whose result is stored.
    """
    own = Window.partitionBy("key").orderBy("id")

    def meet(band: DataFrame) -> DataFrame:
        b = band.withColumns({"at": F.row_number().over(own) - 1, "n": F.count("*").over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))}).where("n > 1")
        b = b.withColumn("before", F.when(F.col("n") <= block, F.collect_list(F.struct("id", "sketch")).over(own.rowsBetween(-block, -1))))
        met = F.filter("before", lambda o: _agree(o["sketch"], "sketch") >= SKETCH_AGREE)
        nobody = F.lit(None).cast(band.schema["id"].dataType)
        b = b.withColumn("other", F.explode(F.when(F.col("n") <= block, F.transform(met, lambda o: o["id"])).otherwise(F.array(nobody))))
        # pairs of small buckets, and the rows of large ones
        hot = F.col("other").isNull()
        return stored(b.select(F.col("other").alias("a"), "id", F.when(hot, F.col("key")).alias("key"), F.when(hot, F.col("sketch")).alias("sketch"), F.when(hot, F.floor(F.col("at") / block)).alias("block")))

    side = lambda c, k: maps.select(F.col("id").alias(c), F.col("n").alias(f"n{k}"), F.col("p").alias(f"p{k}"), F.col("q").alias(f"q{k}"))
    b = _union([meet(x) for x in ([bands] if isinstance(bands, DataFrame) else bands)])
    n_large, n_joined, n_small = b.agg(F.count("key"), F.coalesce(F.sum(F.col("block") + 1), F.lit(0)), F.count("a")).first()
    found = []
    if n_large:
        large = b.where("a IS NULL").select("id", "key", "sketch", "block")
        if maps is not None:
            large = stored(large.join(side("id", 1), "id"))
        for part in _parts(large, "key", n_joined, most):
            left = part.withColumnsRenamed({"id": "a", "sketch": "s"})
            right = part.withColumnsRenamed({"id": "b", "n1": "n2", "p1": "p2", "q1": "q2"}).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "block")))
            split = left.join(right, ["key", "block"]).where("a < b").where(_agree("s", "sketch") >= SKETCH_AGREE)
            found.append(stored((split if maps is None else split.where(_may_reach(threshold))).select("a", "b").distinct()))
    for part in _parts(b.where("a IS NOT NULL").select("a", F.col("id").alias("b")), "a", n_small, most):
        small = part.distinct()
        found.append(stored(small if maps is None else small.join(side("a", 1), "a").join(side("b", 2), "b").where(_may_reach(threshold)).select("a", "b")))
    return _union(found).distinct()


def similar_texts(records: DataFrame, id_col: str, text_col: str, threshold: float, least_words: int = 8, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links): the class representative of every record, and the pairs of representatives that are similar.

    members: (id, rep); records with the same words share a representative (their smallest id).
    links: (rep_a, rep_b, similarity) with rep_a < rep_b and Jaccard similarity of the word sets >= threshold.
    Null texts and texts under ``least_words`` distinct words take no part. Ids must be unique and sortable.
    """
    with shuffles_freed(records.sparkSession):
        return _similar_texts(records, id_col, text_col, threshold, least_words, bands, rows)


def _similar_texts(records: DataFrame, id_col: str, text_col: str, threshold: float, least_words: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    spark = records.sparkSession
    id_type = records.schema[id_col].dataType.simpleString()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t in zip(b["id"], b["text"]):
                w = word_set(t)
                if len(w) >= least_words:
                    s = " ".join(w)
                    d = xxhash.xxh3_128_digest(s)
                    out.append((i, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), *bit_map(w), s))
            yield pd.DataFrame(out, columns=["id", "k1", "k2", "m1", "m2", "words"])

    # texts are split into words once; 128 bits stand for the word set while grouping
    texts = records.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL AND id IS NOT NULL")
    sets = stored(texts.mapInPandas(split, f"id {id_type}, k1 bigint, k2 bigint, m1 bigint, m2 bigint, words string"))
    reps = stored(sets.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.min("m1").alias("m1"), F.min("m2").alias("m2"), F.min("words").alias("words")).withColumn("size", F.size(F.split("words", " "))))
    members = stored(sets.select("id", "k1", "k2").join(reps.select("k1", "k2", "rep"), ["k1", "k2"]).select("id", "rep"))
    discard(sets)

    n, occurrences = reps.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    word = reps.select(F.explode(F.split("words", " ")).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    common = word.where(F.col("df") >= max(COMMON_SHARE * (n + PRIOR_RECORDS), occurrences / MOST_COMMON)).toPandas()
    common["id"] = np.array([word_id(w) for w in common["w"]], np.uint64)
    common = common.sort_values("id")
    rare = -float(np.log(COMMON_SHARE))
    weights = np.clip(-np.log(common["df"].to_numpy(np.float64) / (n + PRIOR_RECORDS)), LEAST_WEIGHT, rare)
    shared = spark.sparkContext.broadcast((common["id"].to_numpy(np.uint64), weights))

    # 32 bits of a key are enough beside the sketch; each round reads its own column
    most = max(ROUND_ROWS, n * bands // 12)
    rounds = np.array_split(np.arange(bands), min(bands, max(1, -(-n * bands // most))))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weight = shared.value
        for b in batches:
            if len(b):
                keys, sketch = min_max_signature([np.fromiter(map(word_id, s.split(" ")), np.uint64) for s in b["words"].to_pylist()], ids, weight, rare, bands, rows)
                short = keys.astype(np.uint32).view(np.int32)
                lists = [pa.ListArray.from_arrays(np.arange(len(b) + 1, dtype=np.int32) * len(r), np.ascontiguousarray(short[:, r]).ravel()) for r in rounds]
                yield pa.RecordBatch.from_arrays([b["id"], pa.array(sketch.view(np.int64)), *lists], ["id", "sketch", *(f"r{k}" for k in range(len(rounds)))])

    signed = stored(reps.select(F.col("rep").alias("id"), "words").mapInArrow(sign, f"id {id_type}, sketch bigint, " + ", ".join(f"r{k} array<int>" for k in range(len(rounds)))))
    of_round = lambda k, r: signed.select("id", "sketch", F.posexplode(f"r{k}").alias("band", "key")).select("id", "sketch", ((F.col("band") + int(r[0])).cast("bigint") * (1 << 32) + F.col("key")).alias("key"))
    maps = reps.select(F.col("rep").alias("id"), F.col("size").alias("n"), F.col("m1").alias("p"), F.col("m2").alias("q"))
    near = cut(bucket_pairs([of_round(k, r) for k, r in enumerate(rounds)], BLOCK, maps, threshold, most))
    discard(signed)

    x, y = F.split("x", " "), F.split("y", " ")
    common_words = F.size(F.array_intersect(x, y))
    links = (
        near.join(reps.select(F.col("rep").alias("a"), F.col("words").alias("x")), "a")
        .join(reps.select(F.col("rep").alias("b"), F.col("words").alias("y")), "b")
        .select("a", "b", common_words.alias("common"), (F.size(x) + F.size(y)).alias("both"))
        .withColumn("similarity", F.col("common") / (F.col("both") - F.col("common")))
        .where(F.col("similarity") >= threshold)
        .select(F.col("a").alias("rep_a"), F.col("b").alias("rep_b"), "similarity")
    )
    return members, cut(links)


def near_duplicate_pairs(records: DataFrame, id_col: str, text_col: str, threshold: float, least_words: int = 8) -> DataFrame:
    """(id_a, id_b, similarity) of every pair of records at or above the threshold, copies included."""
    members, links = similar_texts(records, id_col, text_col, threshold, least_words)
    a = members.select(F.col("rep").alias("rep_a"), F.col("id").alias("x"))
    b = members.select(F.col("rep").alias("rep_b"), F.col("id").alias("y"))
    across = links.join(a, "rep_a").join(b, "rep_b").select("x", "y", "similarity")
    same = members.join(members.select("rep", F.col("id").alias("y")), "rep").where("id < y").select(F.col("id").alias("x"), "y", F.lit(1.0).alias("similarity"))
    return across.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "similarity")


def near_duplicate_classes(records: DataFrame, id_col: str, text_col: str, threshold: float, least_words: int = 8) -> DataFrame:
    """One row per record: (id, class_id, links). class_id is the smallest id reachable over links between different
    texts or identity of word sets; links counts the different similar texts. Records that take no part (null, few
    words) are their own class with 0 links. Copies are not expanded into pairs."""
    members, links = similar_texts(records, id_col, text_col, threshold, least_words)
    comp = connected_components(links, "rep_a", "rep_b").select(F.col("node").alias("rep"), "component")
    degree = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    known = members.join(comp, "rep", "left").join(degree, "rep", "left").select("id", F.coalesce("component", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    every = records.select(F.col(id_col).alias("id"))
    return every.join(known, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
