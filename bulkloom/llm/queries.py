"""The numbered queries, each its operator over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from . import embedding_dedup, exact_dedup, importance, langid, lexical, mixing, pii, secrets, sentencepiece_bpe, sharding, simhash, substring_dedup, toxicity
from .common import read_table
from .sql import ORACLE_SQL


def _over(op, table: str = "documents"):
    return lambda spark, sf_dir: op(read_table(spark, sf_dir, table))


QUERIES = {
    "op1_shard": _over(sharding.op1),
    "op2_exact_dedup": _over(exact_dedup.op2),
    "op3_pii": _over(pii.op3),
    "op4_substring_dedup": _over(substring_dedup.op4),
    "op5_secrets": _over(secrets.op5),
    "op6_mix": _over(mixing.op6),
    "op7_simhash": _over(simhash.op7),
    "op8_language": _over(langid.op8),
    "op9_sentencepiece": _over(sentencepiece_bpe.op9),
    "op10_embedding_dedup": _over(embedding_dedup.op10, "embeddings"),
    "op11_resample": lambda spark, sf_dir: importance.op11(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")),
    "op13_toxicity": lambda spark, sf_dir: toxicity.op13(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")),
    "op12_lexical": lambda spark, sf_dir: lexical.op12(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")),
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}
