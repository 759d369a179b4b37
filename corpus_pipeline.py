"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, encoding; each stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bulkloom.llm import exact_dedup, langid, mixing, near_jaccard, sentencepiece_bpe
from bulkloom.llm.common import materialise, read_table, shield


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (operator 8); the others go.

    Null and empty texts and texts without a letter go, as does what scores too low; texts of any length are read whole.
    Repeated rows are judged alike, so both stay or go. Without a labelled document nothing can be told and all go;
    an empty table gives an empty one. Columns stay as they are, whatever they are called.
    """
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (operator 2): that with the largest doc_id.

    Null counts as the empty text. Null doc_ids rank last, and of rows that share the doc_id that stays one is
    kept, the first in the scan. An empty table gives an empty one; columns stay, one called `kept` too.
    """
    inner, restore = shield(docs, ["doc_id", "text"])
    return restore(exact_dedup.exact_dedup(inner).where("kept"), [])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word similarity of 0.8 or more, all links by exact comparison.

    Of a group the smallest doc_id stays, null ids last, and of several such rows the first in the scan. Null and
    empty texts are equal to each other; a text of fewer than five words is one shingle. An empty table gives an
    empty one; columns stay as they are.
    """
    return near_jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's target asks (operator 6): none, one or two times.

    Null sources are one source, last in order; null and empty texts have size 0 and follow their source's rate. Repeated rows
    have coins of their own. An empty table gives an empty one; columns stay as they are.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids, ids_sha256, decoded_sha256): tokens of every row, with an end id, and digests of them and of what they decode to.

    Null and empty texts are the end id alone; texts of any length are encoded whole; repeated rows give repeated
    rows. An empty table gives an empty one; other columns end here.
    """
    return sentencepiece_bpe.encode_documents(docs.select("doc_id", "source", "lang", "text"), sentencepiece_bpe.default_model(), ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep_text=False)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("encode", encode)]

#: The network, the fingerprints and the tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written as Parquet in the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
