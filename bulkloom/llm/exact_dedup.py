"""Exact dedup: groups by a 128-bit content hash, compares bytes inside the groups, keeps one row of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_ordinal, shield, stored

_ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """docs with keep_id, group_size, kept and text_sha256; one row for each row of docs.

    Rows are grouped by md5, a 128-bit hash of the text. Bytes are compared by grouping on the hash and the text
    itself: partial aggregation keeps one text per group and task, so a group with a third of all rows crosses the
    shuffle once per task. Two texts with one hash become two groups, which the sha256 tells apart for the join
    back; should two texts share both hashes, the query stops with an error and merges nothing.

    keep: "largest" or "smallest" doc_id stays. Null text counts as the empty text. Null doc_ids rank after all
    others. Of rows that share the doc_id that stays, exactly one is kept. Columns of docs with the added
    names are replaced, all others stay; an empty table gives an empty one.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    sign = 1 if keep == "largest" else -1
    text = F.coalesce(F.col("text"), F.lit(""))
    rank = F.coalesce(F.col("doc_id") * sign, F.lit(-(2**63)))
    inner, restore = shield(stored(docs), ["doc_id", "text"])
    rows = inner.withColumns({"_md5": F.unhex(F.md5(text)), "_sha": F.unhex(F.sha2(text, 256)), "_ord": row_ordinal()})
    texts = rows.select("_md5", "_sha", text.alias("_text"), "doc_id", rank.alias("_rank"), "_ord").groupBy("_md5", "_sha", "_text").agg(F.count("*").alias("n"), F.max("_rank").alias("r"), F.max_by("_ord", "_rank").alias("o"), F.max_by("doc_id", "_rank").alias("id"))
    one = F.when(F.count("*") > 1, F.raise_error(F.lit("two texts share md5 and sha256"))).otherwise(F.sum("n"))
    groups = texts.groupBy("_md5", "_sha").agg(one.cast("long").alias("group_size"), F.max_by("id", "r").alias("keep_id"), F.max_by("o", "r").alias("_keep_ord"))
    groups = groups.select(F.concat("_md5", "_sha").alias("_key"), "group_size", "keep_id", "_keep_ord")
    out = rows.withColumn("_key", F.concat("_md5", "_sha")).join(groups, "_key")
    return restore(out.withColumns({"kept": F.col("_ord") == F.col("_keep_ord"), "text_sha256": F.lower(F.hex("_sha"))}), _ADDED)


def op2(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs.select("doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
