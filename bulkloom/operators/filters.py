"""Row filters of the three designs, the short-contig rule and the filter funnel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.genotype import is_biallelic, is_called, is_homozygous
from ..session import materialise
from .stages import chosen_partitions

#: Least depths, inclusive.
MIN_DEPTH = {"hp": 5, "lp": 5, "hb": 40, "lb": 40, "b": 40}
DESIGNS = {"two_bulk": ("hp", "lp", "hb", "lb"), "two_bulk_only": ("hb", "lb"), "one_bulk": ("hp", "lp", "b")}


def passes(design: str, min_depth: dict[str, int] | None = None) -> Column:
    """The design's filter as one predicate: called, deep and biallelic in every role; parents homozygous and different.

    Tests are in order of what they cost, as a row that fails one is not asked the next: depths, genotypes, allele depths.
    """
    least, roles = MIN_DEPTH | (min_depth or {}), DESIGNS[design]
    tests = [F.col(f"{r}_dp") >= least[r] for r in roles] + [is_called(F.col(f"{r}_gt")) for r in roles]
    if "hp" in roles:
        tests += [is_homozygous(F.col("hp_gt")), is_homozygous(F.col("lp_gt")), F.col("hp_gt") != F.col("lp_gt")]
    return reduce(lambda a, b: a & b, tests + [is_biallelic(F.col(f"{r}_ad")) for r in roles])


def contig_ends(variants: DataFrame) -> DataFrame:
    """(chrom, max_pos)."""
    return variants.groupBy("chrom").agg(F.max("pos").alias("max_pos"))


def stored_contig_ends(spark: SparkSession, path: str) -> DataFrame:
    """(contig, max_pos) of a Parquet table with a folder per contig: from the files' footers, no row is read.

    The second version of the Parquet source hands aggregates over a partition's columns down to the footers; it is used for
    this read alone.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in before.split(",") if x != "parquet"))
    try:
        table = spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
    return table.groupBy("contig").agg(F.max("pos").alias("max_pos"))


def long_stored_contigs(spark: SparkSession, path: str, window: int, step: int) -> DataFrame:
    """Rows of such a table on contigs whose last position lies beyond window + step: ends from footers, then the folders of these contigs alone."""
    ends = materialise(stored_contig_ends(spark, path), "contig-ends")
    return chosen_partitions(spark.read.parquet(path), "contig", ends.where(F.col("max_pos") > window + step))


def drop_short_contigs(variants: DataFrame, window: int, step: int) -> DataFrame:
    """Rows of contigs whose last position, over all rows, lies beyond window + step.

    Rows stay where they are: there is at most one such contig for each window + step bases of a genome, so their names are
    broadcast, while a shuffle by contig would bring all rows of a chromosome into one task.
    """
    good = contig_ends(variants).where(F.col("max_pos") > window + step).select("chrom")
    return variants.join(F.broadcast(good), "chrom", "left_semi")


def filter_design(variants: DataFrame, design: str, window: int, step: int, min_depth: dict[str, int] | None = None) -> DataFrame:
    """Short contigs go first, judged on the unfiltered table, then the design's filter."""
    return drop_short_contigs(variants, window, step).where(passes(design, min_depth))


def funnel(variants: DataFrame, design: str, window: int, step: int) -> DataFrame:
    """(original, on_long_contigs, filtered) in one pass: counts per contig, then a sum over contigs."""
    per = variants.groupBy("chrom").agg(F.max("pos").alias("m"), F.count("*").alias("n"), F.count_if(passes(design)).alias("p"))
    long_ = F.col("m") > window + step
    return per.agg(F.sum("n").alias("original"), F.coalesce(F.sum(F.when(long_, F.col("n"))), F.lit(0)).alias("on_long_contigs"), F.coalesce(F.sum(F.when(long_, F.col("p"))), F.lit(0)).alias("filtered"))
