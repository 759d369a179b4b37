"""The near-dedup stage against all pairs by brute force."""

import random

import corpus_pipeline
from pyspark.sql import functions as F
from bulkloom.llm import near_jaccard

from .conftest import prose


def _grams(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def _kept(rows):
    """How many rows stay, by all pairs."""
    sets, root = [_grams(t) for t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if _linked(sets[i], sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def _edited(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def _near(spark, texts, at):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(at)
    return {r["doc_id"] for r in corpus_pipeline.near(spark, spark.read.parquet(at), at).collect()}


def test_every_link_of_the_similarity(spark, tmp_path):
    """Copies on both sides of 0.8, also of groups whose members link only through others; a group larger than the pivots."""
    rng = random.Random(4)
    texts = [prose(rng, 200) for _ in range(60)]
    texts += [_edited(rng, t, n) for t in texts[:40] for n in (2, 3, 4, 5, 6)] + [_edited(rng, texts[50], rng.choice([1, 3, 4, 5])) for _ in range(40)]
    roots = _kept(texts)
    least = {}
    for k, r in enumerate(roots):
        least.setdefault(r, k)
    assert _near(spark, texts, str(tmp_path / "d")) == set(least.values())


def test_a_row_goes_only_for_a_similar_one(spark, tmp_path):
    """Texts of which a repeated line makes most fingerprint bits, but few distinct shingles, stay."""
    rng = random.Random(5)
    texts = ["the very same line " * 60 + prose(rng, 12) for _ in range(12)]
    assert _near(spark, texts, str(tmp_path / "d")) == set(range(12))


def test_messy_rows(spark, docs, nothing):
    kept = near_jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(_kept([r["text"] for r in docs.collect()])))
    assert near_jaccard.keep_one(nothing).count() == 0


def test_a_hot_shingle_is_ranked_in_parts(spark):
    """Ranks of a bucket that all rows share are 1 to its size, and no window partition holds the bucket."""
    keyed = spark.range(20_000).select(F.col("id").alias("node"), F.lit(5).alias("n"), F.lit(0).alias("pos"), F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).cast("long").alias("key"))
    keyed = keyed.union(spark.createDataFrame([(1, 5, 1, 10**6), (2, 5, 1, 10**6)], keyed.schema))
    out = near_jaccard.ranked_buckets(keyed)
    rows = out.collect()
    assert sorted(r["rank"] for r in rows if r["key"] == 7) == list(range(1, 18_001)) and {r["size"] for r in rows if r["key"] == 7} == {18_000}
    assert sorted((r["node"], r["rank"], r["size"]) for r in rows if r["key"] == 10**6)[0][2] == 2 and len(rows) == 18_002
    of_salt = keyed.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(near_jaccard.SALTS))).count().agg(F.max("count")).first()[0]
    assert of_salt < 18_000 / near_jaccard.SALTS * 1.5 and "hashpartitioning(key#" in out._jdf.queryExecution().executedPlan().toString()
    rest = spark.createDataFrame([(1, 4), (1, 4), (2, 3), (2, 5), (2, 3)], "key long, root long")
    assert sorted(map(tuple, near_jaccard.in_several(rest).collect())) == [(2, 3), (2, 3), (2, 5)]
