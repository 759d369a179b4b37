"""The language stage on tables without labels or rows, and its rejection score."""

import random

import corpus_pipeline
from bulkloom.llm import langid
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_without_labels_or_rows(spark, tmp_path):
    rows = [(k, f"some words of text number {k}", None, "a", 20) for k in range(30)]
    for name, given in (("unlabelled", rows), ("empty", [])):
        spark.createDataFrame(given, COLUMNS).write.parquet(str(tmp_path / name / "documents.parquet"))
        docs = spark.read.parquet(str(tmp_path / name / "documents.parquet"))
        assert langid.keep_identified(docs).columns == docs.columns and langid.keep_identified(docs).count() == 0
        assert corpus_pipeline.run(spark, str(tmp_path / name)).count() == 0


def test_rejection_score_follows_the_languages(spark, tmp_path, monkeypatch):
    """With two languages the best mean is at least 0.5, so a text between both lies below the score only if that is above 0.5."""
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["abba", "baab", "aab"] if k % 2 else ["xyzzy", "zyx", "yzz"]) for _ in range(30)), "aa" if k % 2 else "xx", "a", 1) for k in range(300)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    model = langid.train(docs, steps=150)
    score = langid.rejection_score(docs, model)
    held = langid.identify(docs, model).where("held_out AND lang_pred = lang").agg(F.min("score")).first()[0]
    assert 0.5 < score < held
    mixed = langid.ByteGru(["aa", "xx"])
    mixed.p["out"][:] = 0
    assert abs(langid.identify(docs, mixed).first()["score"] - 0.5) < 1e-6 < score - 0.5
    assert langid.rejection_score(docs.where(~langid.held_out(F.col("doc_id"))), model) < 0.5


def test_rejection_score_counts_every_held_out_document(spark):
    """The least scores count wherever they stand: one among 5,000, of a document that a sample of a few hundred would leave out."""
    scores = spark.range(5000).select((F.lit(0.9) + F.col("id") / 100_000).alias("score"))
    for part in (scores, scores.limit(1), scores.limit(2), scores.limit(1001), scores.limit(1500)):
        assert abs(langid.low_end(part) - part.agg(F.percentile("score", langid.LOW_SHARE)).first()[0]) < 1e-12
    assert langid.low_end(scores.limit(0)) is None
    model = langid.ByteGru(["aa", "xx"])
    ids = [k for k, held in spark.range(3000).select("id", langid.held_out(F.col("id"))).collect() if held]
    for odd in (ids[0], ids[-1], ids[len(ids) // 2]):
        scored = spark.createDataFrame([(k, "aa", True, "aa", 0.6 if k == odd else 0.9) for k in ids], "doc_id long, lang string, held_out boolean, lang_pred string, score double")
        assert 0.5 < langid._threshold(scored, model) < 0.7


def test_judged_documents_are_all_of_the_held_out(spark, tmp_path, monkeypatch):
    """Many more labelled documents than a sample of 200 of a language: every held-out one is scored for the rejection score."""
    spark.createDataFrame([(k, "abba baab", "aa", "a", 1) for k in range(3000)], COLUMNS).write.parquet(str(tmp_path / "d"))
    docs, seen = spark.read.parquet(str(tmp_path / "d")), []
    monkeypatch.setattr(langid, "identify", lambda rows, model, keep_text=True, own=langid.identify: seen.append(rows.count()) or own(rows, model, keep_text))
    langid.rejection_score(docs, langid.ByteGru(["aa"]))
    assert seen == [docs.where(langid.held_out(F.col("doc_id"))).count()]
