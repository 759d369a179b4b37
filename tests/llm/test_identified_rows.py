"""The language stage writes scores, not texts, and leaves out the rows that explicit scores would."""

import random

from bulkloom.llm import langid


def test_scores_are_written_without_texts(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = [(None if k % 50 == 7 else k // 2, None if k % 40 == 3 else "12 345 67" if k % 40 == 9 else " ".join(rng.choice(["abba", "baab"] if k % 4 < 2 else ["xyzzy", "zyx"]) for _ in range(20)), None if k % 9 == 0 else "aa" if k % 4 < 2 else "xx", "a", {"n": k}, k % 3) for k in range(400)]
    rows += rows[40:60]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, _ord string, extra map<string,int>, Score int").repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    model, written = langid.train(docs, steps=150), {}
    monkeypatch.setattr(langid, "train", lambda _: model)
    monkeypatch.setattr(langid, "materialise", lambda df, name, own=langid.materialise: written.setdefault(name, own(df, name)))
    got = langid.keep_identified(docs)
    assert "text" not in written["identified"].columns and written["identified"].count() == len(rows)
    table = lambda df: sorted(map(repr, df.collect()))
    assert got.columns == docs.columns and table(got) == table(langid.keep_identified(docs, langid._threshold(written["identified"], model)))
    assert 0 < got.count() < len(rows) and got.where("text IS NULL OR text = '12 345 67'").count() == 0
    # where many rows go, numbers are joined by a shuffle, with the same result
    monkeypatch.setattr(langid, "MAX_BROADCAST", 3)
    written.clear()
    assert table(langid.keep_identified(docs)) == table(got)
    written.clear()
    monkeypatch.setattr(langid, "_threshold", lambda scored, of: 1.1)
    assert langid.keep_identified(docs).count() == 0
