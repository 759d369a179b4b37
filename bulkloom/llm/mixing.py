"""Mixing sources to target weights: repetition rates from word counts, then whole copies plus a seeded coin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_small, materialise, repeat_numbers, row_ordinal, shield, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Seeds tried for each source; the one whose copies come nearest to the target is used.
SEEDS = 16
#: A table of sources is broadcast up to so many rows; beyond it the join shuffles.
MAX_BROADCAST = 100_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The shares go by weight, none above cap times its source; what is cut off is dealt again by weight. That ends
    where every target is min(cap, level x weight), and the level follows from sorting by cap / weight: below
    it sources are full, above it they share the rest. One row per source passes through one window.
    """
    n = len(weights)
    all_rows = W.partitionBy(F.lit(0))
    ranked = sizes.withColumn("_i", (F.row_number().over(all_rows.orderBy(F.col("source").asc_nulls_last())) - 1) % n)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_i") + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", cap * F.col("source_size")).withColumn("_full", F.col("_cap") / F.col("_w"))
    up = all_rows.orderBy("_full", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumns({"_total": F.least(share * F.sum("source_size").over(all_rows), F.sum("_cap").over(all_rows)), "_below": F.coalesce(F.sum("_cap").over(up), F.lit(0.0)), "_w_above": F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(up), F.lit(0.0))})
    # the level if this source and all with larger ratios are not full; the first for which that holds, with the largest value, gives the level
    ranked = ranked.withColumn("_level", (F.col("_total") - F.col("_below")) / F.col("_w_above"))
    level = F.max(F.when(F.col("_level") <= F.col("_full"), F.col("_level"))).over(all_rows)
    return ranked.select("source", "source_size", F.least(F.col("_cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("_w")).alias("target"))


def _coin(seed: Column) -> Column:
    """A number from 0 to 1 from the seed, the doc_id, the text and, for rows that repeat in both, the row's number."""
    digest = F.md5(F.concat_ws("|", seed.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("_text_md5"), F.col("_nth")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def _numbered(rows: DataFrame, numbers: DataFrame | None) -> DataFrame:
    """rows with _nth: the row's number among rows equal in doc_id and text, null where there is no other, which the coin leaves out."""
    if numbers is None:
        return rows.withColumn("_nth", F.lit(None).cast("string")).drop("_ord")
    return rows.join(numbers.withColumn("_nth", F.col("_nth").cast("string")), F.col("_ord") == F.col("_row"), "left").drop("_ord", "_row")


def mixing_plan(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seeds: int = SEEDS) -> DataFrame:
    """docs with size, source_size, target, rate and copies; one row for each row of docs.

    A document is taken floor(rate) times, and once more if its seeded coin falls below the fraction. Each source
    uses that one of `seeds` seeds whose words come nearest to its target, all tried in the same aggregation. Sums
    are partial before the shuffle, so a source with a third of all rows costs a row per task.

    Null text has size 0; null sources form one source, last in order; empty sources get target and rate 0. Rows that
    repeat in doc_id and text have coins of their own, by their numbers among their equals, so a source of equal rows meets
    its target too; runs agree, however files are split. Columns of docs with the added names are replaced. An empty table
    gives an empty one.
    """
    added = ["size", "source_size", "target", "rate", "copies"]
    inner, restore = shield(stored(docs), ["doc_id", "text", "source"])
    rows = inner.withColumns({"size": n_words(F.col("text")), "_text_md5": F.md5(F.coalesce(F.col("text"), F.lit(""))), "_ord": row_ordinal()})
    keys = materialise(rows.select("source", "size", "doc_id", "_text_md5", "_ord"), "mix-sizes")
    numbers = repeat_numbers(keys.select("_ord", F.xxhash64("doc_id", "_text_md5", "source").alias("_key")))
    keys, rows = _numbered(keys, numbers), _numbered(rows, numbers)
    rates = materialise(targets(keys.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap).withColumn("rate", F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))), "mix-rates")
    rates = broadcast_if_small(rates.withColumnRenamed("source", "_source"), MAX_BROADCAST)
    fraction = F.col("rate") - F.floor("rate")
    tried = keys.join(rates, F.col("source").eqNullSafe(F.col("_source"))).groupBy("_source").agg(F.first("target").alias("t"), F.first("rate").alias("r"), F.sum("size").alias("s"), *(F.sum(F.when(_coin(F.lit(k)) < fraction, F.col("size")).otherwise(0)).alias(f"x{k}") for k in range(seeds)))
    miss = lambda k: F.abs(F.floor("r") * F.col("s") + F.col(f"x{k}") - F.col("t"))
    best = tried.select(F.col("_source").alias("_of"), F.array_min(F.array(*(F.struct(miss(k).alias("m"), F.lit(k).alias("k")) for k in range(seeds))))["k"].alias("_seed"))
    best = materialise(best, "mix-seeds")
    plan = materialise(rates.join(best, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of"), "mix-plan")
    plan = broadcast_if_small(plan, MAX_BROADCAST)
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    copies = (F.floor("rate") + F.when(_coin(F.col("_seed")) < fraction, 1).otherwise(0)).cast("long")
    return restore(out.withColumn("copies", copies), added)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as often as its copies say, with the columns of docs."""
    inner, restore = shield(docs, ["doc_id", "text", "source"])
    plan = mixing_plan(inner, **options).where("copies > 0")
    return restore(plan.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), [])


def op6(docs: DataFrame) -> DataFrame:
    return mixing_plan(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
