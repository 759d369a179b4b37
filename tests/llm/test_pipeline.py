"""The stages against brute-force versions, each on what the stage before it kept."""

import collections
import hashlib

import corpus_pipeline
import sentencepiece
from bulkloom.llm import sentencepiece_bpe

from ..conftest import SF
from .test_llm import WORD
from .test_near_jaccard import _grams, _kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _encoded(rows):
    """What the library makes of each row."""
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    out = []
    for r in rows:
        ids = sp.encode(r["text"] or "", add_eos=True)
        out.append((r["doc_id"], r["source"], r["lang"], len(ids), tuple(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    return collections.Counter(out)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    given, language, exact, near, mixed, encoded = kept
    assert set(language) <= set(given) and len(language) >= 0.97 * len(given)
    best = {}
    for r in language:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in exact) == sorted(best.values())
    least = {}
    for r, root in zip(exact, _kept([r["text"] for r in exact]), strict=True):
        least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in near) == sorted(least.values()) and set(near) <= set(exact)
    copies, words = collections.Counter(r["doc_id"] for r in mixed), collections.Counter()
    total = sum(len(WORD.findall(r["text"])) for r in near)
    for r in mixed:
        words[r["source"]] += len(WORD.findall(r["text"]))
    assert set(copies) <= {r["doc_id"] for r in near} and max(copies.values()) <= 2 and abs(sum(words.values()) - 1.5 * total) < 0.1 * total
    assert collections.Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in encoded) == _encoded(mixed)


def test_stages_on_messy_and_empty_tables(spark, docs, nothing):
    """Nulls, empty and very long texts, ties, repeated rows and names that operators use inside: each stage on the same table."""
    rows = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    exact = stages["exact_dedup"](spark, docs, "")
    assert exact.columns == docs.columns
    best = {}
    for r in rows:
        best.setdefault(r["text"] or "", []).append(r["doc_id"])
    got = collections.defaultdict(list)
    for r in exact.collect():
        got[r["text"] or ""].append(r["doc_id"])
        assert tuple(r) in {tuple(x) for x in rows}
    assert got == {t: [max((i for i in ids if i is not None), default=None)] for t, ids in best.items()}
    near = stages["near_dedup"](spark, docs, "").collect()
    assert len(near) == len(set(_kept([r["text"] for r in rows]))) and {tuple(r) for r in near} <= {tuple(r) for r in rows}
    mixed = stages["mix"](spark, docs, "")
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in rows}
    language = stages["language"](spark, docs, "")
    assert language.columns == docs.columns
    assert all(any(c.isalpha() for c in r["text"]) for r in language.collect())
    encoded = stages["encode"](spark, docs, "").collect()
    assert collections.Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in encoded) == _encoded(rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0, name


def test_recall_of_near_copies(spark, tmp_path):
    """All pairs of the test table with a similarity of 0.8 or more end in one group: a recall of 1."""
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["text"])
    given.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows = docs.collect()
    sets = [_grams(r["text"]) for r in rows]
    stays = {r["doc_id"] for r in corpus_pipeline.near(spark, docs, "").collect()}
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert not any(rows[i]["doc_id"] in stays and rows[j]["doc_id"] in stays for i, j in pairs)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and {"doc_id", "n_tokens", "ids"} <= set(out.columns)
