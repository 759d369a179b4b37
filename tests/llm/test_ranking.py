"""Resampling, lexical search and toxicity against brute-force versions, on a messy table, on an empty one and on the small test tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bulkloom.llm import importance, lexical, queries, terms, toxicity

from ..conftest import SF, SF_LARGER

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_words_cut_nowhere():
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("aB9é日 \n.,x") for _ in range(rng.randrange(300)))
        for limit in (1, 7, 1 << 20):
            assert [w.decode() for part in terms.word_lists(text.encode(), limit) for w in part] == words_of(text)
    assert list(terms.word_lists(None)) == []


# -- 11 resampling


def features_of(text):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket_of(feature):
    return zlib.crc32(feature.encode()) % 10_000


def resample_by_loop(docs, target):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text)."""
    s, t = (collections.Counter(bucket_of(f) for x in texts for f in features_of(x)) for texts in ([x for _, x in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, x in docs:
        f = features_of(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket_of(k)] for k in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0))), len(words_of(x)) >= 20])
    best = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(best[: len(best) * 5 // 100])}
    return [(*r[:4], drawn.get(id(r))) for r in rows]


def test_hashes_equal_the_libraries():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(5000))
    length = np.array([rng.choice([0, 1, 3, 4, 7, 8, 9, 31, 32, 33, 63, 64, 100, 1500, rng.randrange(1000)]) for _ in range(2000)])
    start = np.array([rng.randrange(5001 - n) for n in length])
    b = importance.Bytes(data)
    parts = [data[a : a + n] for a, n in zip(start, length, strict=True)]
    assert b.xxhash64(start, length).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]
    assert b.crc32(start, length).tolist() == [zlib.crc32(p) for p in parts]


def test_interned_ngrams_are_told_apart_by_bytes(monkeypatch):
    """Even where all hashes are equal, places belong to one n-gram each."""
    texts = [b"a b a b c", b"longer words than eight bytes, longer words", b"", None, b"b a b"]
    for hashes in (None, lambda self, start, length: np.zeros(start.size, np.uint64)):
        if hashes:
            monkeypatch.setattr(importance.Bytes, "xxhash64", hashes)
        (piece,) = importance.batches_of(texts)
        data, start, length, row, of_word = importance.ngrams(*piece)
        grams = [data.data[a : a + n].decode() for a, n in zip(start, length, strict=True)]
        made = importance.Interned(data, start, length)
        by_place = collections.defaultdict(set)
        for g, s in zip(grams, made.slot.tolist(), strict=True):
            by_place[s].add(g)
        assert all(len(v) == 1 for v in by_place.values()) and len(by_place) == len(set(grams)) == len(made.used)
        assert {next(iter(v)): made.count[s] for s, v in by_place.items()} == collections.Counter(grams)
        assert all(made.bucket[s] == bucket_of(next(iter(v))) for s, v in by_place.items())
        assert collections.Counter(row.tolist()) == {i: len(features_of(t.decode())) for i, t in enumerate(texts) if t} and collections.Counter(of_word.tolist()) == {0: 5, 1: 7, 4: 3}


def test_long_texts_are_cut_without_loss():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "bb", "cé"]) for _ in range(400)).encode(), b"x y", b"z"]
    want = [collections.Counter(features_of(t.decode())) for t in texts]
    got = [collections.Counter() for _ in texts]
    for piece in importance.batches_of(texts, 64):
        data, start, length, row, _ = importance.ngrams(*piece)
        for a, n, r in zip(start, length, row, strict=True):
            got[r][data.data[a : a + n].decode()] += 1
    assert got == want


def test_resample(docs, spark):
    target = table(spark, "benchmark")
    out = importance.resample(docs, target)
    assert {"lang", "source", "n_chars", "_ord", "rid", "_extra", "kept", "size"} <= set(out.columns)
    want = resample_by_loop([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    key = lambda rows: sorted((tuple(r) for r in rows), key=str)
    assert key(out.select("doc_id", "n_features", "weight", "score", "rank").collect()) == key(want)


def test_resample_of_nothing(nothing, spark, docs):
    assert importance.resample(nothing, table(spark, "benchmark")).count() == 0
    assert importance.resample(docs, nothing).count() == docs.count()


def test_op11(spark):
    docs, target = table(spark, "documents"), table(spark, "benchmark")
    want = resample_by_loop([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    got = queries.queries()["op11_resample"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(want, key=lambda r: r[0]) and sum(r["rank"] is not None for r in got) > 5


# -- 12 lexical search


def search_by_loop(docs, items, k=50):
    bags = [(i, collections.Counter(words_of(t))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    total = sum(n for *_, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        terms_ = set(words_of(text)) & set(df)
        w = {t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) for t in terms_}
        scored = []
        for i, b, n in bags:
            m = 100 - 50 + (50 * n * len(bags)) // total
            scored.append((sum(w[t] * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in terms_ if b[t]), i))
        best = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search(docs, spark, k):
    """Ties of copies, repeated ids and items, null ids and texts."""
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(0, "the of and WORD"), (1, None), (2, ""), (3, "one two é 日本"), (3, rows[0][1]), (None, rows[1][1]), (5, "nowhere"), (6, rows[1][1]), (6, rows[1][1])]
    table_ = spark.createDataFrame([(*x, "more") for x in items], "item_id long, text string, doc_id string")
    assert found(lexical.search(docs, table_, k)) == search_by_loop(rows, items, k)


def test_search_in_blocks(docs, spark, monkeypatch):
    """Small blocks and score matrices give the same."""
    monkeypatch.setattr(lexical, "BLOCK_PAIRS", 40)
    monkeypatch.setattr(lexical, "CELLS", 30)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(i, rows[i][1]) for i in (0, 1, 2, 5)]
    assert found(lexical.search(docs, spark.createDataFrame(items, "item_id int, text string"), 5)) == search_by_loop(rows, items, 5)


def test_search_of_nothing(docs, nothing, spark):
    items = spark.createDataFrame([(1, "the")], "item_id int, text string")
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"] and lexical.search(docs, items.limit(0)).count() == 0


def test_a_class_of_many_copies_passes_on_few_rows(spark):
    bagged = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(3).cast("long").alias("n"), F.concat(F.lit("1234567"), F.col("id") % 2).cast("binary").alias("bag"))
    out = lexical.classes(bagged, 5000, 15_000, 7)
    assert sorted(r["members"] for r in out.collect()) == [list(range(0, 14, 2)), list(range(1, 14, 2))]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


# -- 13 toxicity


def nearest_by_loop(rows, idf, terms_, k, leave_out=None):
    """(cosine, id) of the k nearest of (id, label, terms), by dense vectors."""
    def vector(t):
        v = np.zeros(len(idf))
        v[t] = idf[t]
        return v / max(np.linalg.norm(v), 1e-300)

    q = vector(terms_)
    scored = [(float(q @ vector(t)), i) for i, _, t in rows if i != leave_out]
    return sorted((x for x in scored if x[0] > 0), key=lambda x: (-round(x[0], 9), x[1]))[:k]


@pytest.mark.parametrize("seed", range(4))
def test_block_max_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    n_terms = 40
    idf = rng.uniform(1, 6, n_terms)
    rows = [(i, int(rng.random() < 0.3), np.sort(rng.choice(n_terms, rng.integers(0, 9), replace=False))) for i in range(900)]
    rows += [(1000 + i, 1, rows[5][2]) for i in range(70)]  # ties over blocks
    index = toxicity.Index(rows, idf)
    assert index.blocks > 10
    for k in (1, 9):
        for i, _, t in [*rows[:120], rows[-1], (-1, 0, np.array([3, 7, 20]))]:
            near, who = index.nearest(t, k, index.number.get(i, -1))
            want = nearest_by_loop(rows, idf, t, k, leave_out=i)
            assert np.allclose(near, [c for c, _ in want], atol=1e-9) and len(who) == len(want)
            if len({round(c, 9) for c, _ in want}) == len(want):  # without ties the same examples
                assert index.id[who].tolist() == [i for _, i in want]


def test_pieces_are_found_as_they_are_counted():
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(rng.choice(["ha", "é", "b", " ", "HAHA", "x1 ", "\n"]) for _ in range(80))
        want = collections.Counter(p for w in words_of(text) for p in toxicity.pieces(w.encode()))
        known = rng.sample(sorted(want), min(20, len(want))) + [b"^zzz$"]
        assert toxicity.Finder(known)(text.encode()) == {p: want[p] for p in known if want[p]}
    assert toxicity.Finder([])(b"some text") == {} and toxicity.Finder([b"^a$"])(None) == {}


def test_an_index_without_examples():
    index = toxicity.Index([], np.ones(3))
    assert index.nearest(np.array([1]), 5)[1].size == 0 and index.vote(*index.nearest(np.array([], int), 5)) == -1


def test_calibration_rises_and_keeps_shares():
    rng = random.Random(5)
    votes = [round(rng.random(), 2) for _ in range(500)] + [-1.0] * 40
    labels = [int(rng.random() < max(v, 0)) for v in votes]
    share = toxicity.Calibration(votes, labels)
    out = [share(v) for v in sorted(set(votes))]
    assert out == sorted(out) and abs(sum(map(share, votes)) - sum(labels)) < len(share.at)
    assert share(-5) == share.overall and toxicity.Calibration([], [])(0.4) == 0.0


def test_toxicity(docs, spark):
    """A hot term is found in held-out and unlabelled documents; clean ones, empty and null texts stay below the threshold."""
    rng = random.Random(8)
    plain = [f"the {rng.choice(['cat', 'dog', 'cow'])} is on {rng.choice(['a', 'the'])} mat of {rng.choice('pqrst')}{k % 40}" for k in range(300)]
    rows = [(1000 + k, t + (" you grumbling numbskull!" if k % 3 == 0 else "")) for k, t in enumerate(plain)]
    table_ = docs.select("doc_id", "text", "lang", "_ord", "kept").unionByName(spark.createDataFrame([(i, t, "en", "x", "y") for i, t in rows], "doc_id long, text string, lang string, _ord string, kept string"))
    labels = spark.createDataFrame([(i, int("numbskull" in t)) for i, t in rows[:200]] + [(3, 0), (3, None), (None, 1), (99_999, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(table_, labels)
    assert out.columns == ["doc_id", "text", "lang", "_ord", "kept", "score", "predicted", "evidence"] and out.count() == table_.count()
    for r in out.collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) == ("numbskull" in (r["text"] or ""))
        assert all(e["label"] == 1 and e["doc_id"] < 1200 for e in r["evidence"]) or not r["predicted"]
    # labels of held-out documents are never read
    flipped = labels.withColumn("toxic", F.when(toxicity.learns_from(F.col("doc_id")), F.col("toxic")).otherwise(1 - F.col("toxic")))
    key = lambda df: sorted(map(str, df.select("doc_id", "text", "score").collect()))
    assert key(toxicity.score_toxicity(table_, flipped)) == key(out)


def test_toxicity_of_nothing(docs, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(nothing, labels).count() == 0
    none = toxicity.score_toxicity(docs, labels.limit(0))
    assert none.count() == docs.count() and {r["score"] for r in none.collect()} == {0.0}


def test_op13(spark):
    """Over a larger table: held-out documents, by whole brute force of vectors and votes as well."""
    docs, labels = table(spark, "documents", SF_LARGER), table(spark, "labels", SF_LARGER)
    rows = {r["doc_id"]: r for r in queries.queries()["op13_toxicity"](spark, SF_LARGER).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    known = toxicity.examples(docs, labels)
    chosen = toxicity.choose_terms(known)

    def bag(text):
        words = collections.Counter(words_of(text))
        tf = collections.Counter()
        for w, k in words.items():
            for p in toxicity.pieces(w.encode()):
                tf[p] += k
        return np.array([t for t, (p, level) in enumerate(chosen) if tf[p] >= level], int)

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bags = {i: bag(t) for i, t in texts.items()}
    df = np.bincount(np.concatenate([b for b in bags.values() if b.size]), minlength=len(chosen))
    idf = np.log((len(texts) + 1) / (df + 1)) + 1
    index_rows = [(r["doc_id"], r["label"], bags[r["doc_id"]]) for r in known.collect()]
    for i in list(texts)[::7]:
        want = nearest_by_loop(index_rows, idf, bags[i], toxicity.NEIGHBOURS)
        got = [x.split(":") for x in rows[i]["evidence"].split(",") if x]
        assert np.allclose([float(c) for *_, c in got], [c for c, _ in want], atol=2e-6)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(rows[i]["predicted"], y) for i, y in truth.items() if rows[i]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.9
