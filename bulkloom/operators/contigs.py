"""Contig tables and their versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def long_contigs(contigs: DataFrame, least: int = 200) -> DataFrame:
    return contigs.where(F.col("length") >= least)


def rename_scaffolds(contigs: DataFrame) -> DataFrame:
    """contigs with name <sample>_scaff_<n>, numbered within the sample by contig_no.

    The number is the count of contigs in earlier slices of the sample plus the place in the slice, so that a sample
    with most of the contigs is numbered by many tasks.
    """
    sliced = contigs.withColumn("_slice", F.floor(F.col("contig_no") / 100_000))
    counts = sliced.groupBy("sample", "_slice").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("sample").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("sample").alias("_s"), F.col("_slice").alias("_k"), before.alias("_before"))
    placed = sliced.withColumn("_at", F.row_number().over(W.partitionBy("sample", "_slice").orderBy("contig_no")))
    out = placed.join(counts, F.col("sample").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_k")))
    name = F.concat("sample", F.lit("_scaff_"), (F.col("_before") + F.col("_at")).cast("string"))
    return out.withColumn("name", name).select(*contigs.columns)


def latest_version(contigs: DataFrame) -> DataFrame:
    return contigs.agg(F.max("version").alias("version"))


def append_version(reference: DataFrame, new: DataFrame) -> DataFrame:
    """The reference's latest version followed by the new contigs, all under the next version number."""
    top = latest_version(reference).withColumnRenamed("version", "_top")
    now = reference.join(F.broadcast(top), F.lit(True))  # one row
    new = new.join(F.broadcast(top), F.lit(True))
    next_ = (F.col("_top") + 1).alias("version")
    keep = [c for c in reference.columns if c != "version"]
    return now.where(F.col("version") == F.col("_top")).select(*keep, next_).unionByName(new.select(*keep, next_))
