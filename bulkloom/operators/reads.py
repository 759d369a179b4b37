"""Aligned reads: flag filters, unmapped sets, duplicates, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import round6

FLAG_BITS = (("paired", 1), ("proper", 2), ("unmapped", 4), ("mate_unmapped", 8), ("reverse", 16), ("mate_reverse", 32), ("read1", 64), ("read2", 128), ("secondary", 256), ("qc_fail", 512), ("duplicate", 1024), ("supplementary", 2048))


def has(bit: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(bit)) != 0


def flag_filter(reads: DataFrame, required: int, excluded: int) -> DataFrame:
    """Reads with all bits of required and none of excluded."""
    return reads.where((F.col("flag").bitwiseAND(F.lit(required)) == required) & (F.col("flag").bitwiseAND(F.lit(excluded)) == 0))


def unmapped_pairs(reads: DataFrame) -> DataFrame:
    """Primary reads that are unmapped, or whose mate is: one predicate for what are three disjoint flag filters."""
    return reads.where(has(12) & ~has(256))


def name_sort(reads: DataFrame) -> DataFrame:
    return reads.orderBy("qname", has(128))


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """reads(qname, flag, library, rname, five_prime, base_quality_sum, ...) with is_dup.

    Primary mapped reads take part. Two of one name are a pair: pairs of a library are copies if both ends agree in
    contig, unclipped 5' place and strand, and all but the one with the highest sum of qualities are duplicates (of
    equal ones the first name stays). A read whose mate isn't mapped is a duplicate if an end of a pair lies at its
    own, else all but the best such read are. Other reads never are.

    The best of each end are found by aggregation, partial in each task, and joined back, so a place with very many
    reads costs a row per task.
    """
    kept = [F.col(f"`{c}`") for c in reads.columns if c != "is_dup"]
    end = F.struct("rname", "five_prime", (F.col("flag").bitwiseAND(F.lit(16)) != 0).alias("back"))
    takes_part = ~has(4) & ~has(256) & ~has(2048)
    mates = W.partitionBy("library", "qname", takes_part)
    rows = reads.withColumns({"_in": takes_part, "_end": end}).withColumns({"_n": F.count("*").over(mates), "_a": F.min("_end").over(mates), "_b": F.max("_end").over(mates), "_score": F.sum("base_quality_sum").over(mates)})
    rows = rows.withColumn("_pair", F.col("_in") & has(1) & (F.col("_n") == 2))
    place = F.when(F.col("_pair"), F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"))).otherwise(F.struct(F.col("_end").alias("a"), F.col("_end").alias("b")))
    rank = F.struct((-F.when(F.col("_pair"), F.col("_score")).otherwise(F.col("base_quality_sum"))).alias("score"), F.col("qname").alias("name"), F.when(F.col("_pair"), 0).otherwise(F.col("flag")).alias("flag"))
    rows = rows.withColumns({"_place": place, "_rank": rank})
    best = rows.where("_in").groupBy(F.col("library").alias("_l"), F.col("_place").alias("_p"), F.col("_pair").alias("_q")).agg(F.min("_rank").alias("_best"))
    ends = rows.where("_pair").select(F.col("library").alias("_el"), F.col("_end").alias("_ee")).distinct().withColumn("_taken", F.lit(True))
    out = rows.join(best, F.col("library").eqNullSafe(F.col("_l")) & (F.col("_place") == F.col("_p")) & (F.col("_pair") == F.col("_q")) & F.col("_in"), "left")
    out = out.join(ends, F.col("library").eqNullSafe(F.col("_el")) & (F.col("_end") == F.col("_ee")) & F.col("_in") & ~F.col("_pair"), "left")
    dup = F.coalesce(F.col("_taken"), F.lit(False)) | (F.col("_rank") != F.col("_best"))
    return out.select(*kept, F.coalesce(F.when(F.col("_in"), dup), F.lit(False)).alias("is_dup"))


def duplicate_metrics(reads: DataFrame) -> DataFrame:
    return mark_duplicates(reads).groupBy("library").agg(F.count("*").alias("n_reads"), F.count_if("is_dup").alias("n_duplicates"))


def flag_summary(reads: DataFrame) -> DataFrame:
    """Counts of each flag bit, for reads that pass quality control and those that fail, as (measure, passed, failed)."""
    measures = [("total", F.lit(True)), *((name, has(bit)) for name, bit in FLAG_BITS if bit != 512), ("mapped", ~has(4)), ("both_mapped", has(1) & ~has(12))]
    row = reads.agg(*(F.count_if(test & (has(512) if bad else ~has(512))).alias(f"{name}_{int(bad)}") for name, test in measures for bad in (False, True)))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(f"{n}_0").alias("passed"), F.col(f"{n}_1").alias("failed")) for n, _ in measures))).alias("s")).select("s.*")


def alignment_summary(reads: DataFrame) -> DataFrame:
    """(category, total, aligned, mean_length, mean_mapq) of first, second and unpaired primary reads, and of pairs by rollup."""
    own = F.when(~has(1), "UNPAIRED").when(has(64), "FIRST_OF_PAIR").otherwise("SECOND_OF_PAIR")
    measures = [F.count("*").alias("total"), F.count_if(~has(4)).alias("aligned"), F.avg(F.length("seq")).alias("mean_length"), F.avg("mapq").alias("mean_mapq")]
    out = reads.where(~has(256)).withColumn("own", own).withColumn("paired", has(1)).rollup("paired", "own").agg(*measures)
    label = F.coalesce("own", F.when(F.col("paired"), F.lit("PAIR")))
    return out.where(F.col("paired").isNotNull() & (F.col("own").isNotNull() | F.col("paired"))).select(label.alias("category"), "total", "aligned", "mean_length", "mean_mapq")


def insert_size_histogram(reads: DataFrame) -> DataFrame:
    """(insert_size, n) over first reads of pairs."""
    return reads.where(has(64) & (F.col("tlen") != 0)).groupBy(F.abs("tlen").alias("insert_size")).agg(F.count("*").alias("n"))


def insert_size_metrics(reads: DataFrame) -> DataFrame:
    """(pairs, mean, deviation, median, mad, smallest, largest) from the histogram: both medians are weighted, so rows never sort whole."""
    hist = insert_size_histogram(reads)
    middle = hist.agg(F.expr("percentile(insert_size, 0.5, n)").alias("median"))
    off = hist.join(F.broadcast(middle), F.lit(True))  # one row
    x, n = F.col("insert_size").cast("decimal(19,0)"), F.col("n").cast("decimal(19,0)")
    rows = off.agg(F.sum("n").alias("pairs"), F.sum(x * n).cast("double").alias("_x"), F.sum(x * x * n).cast("double").alias("_xx"), F.max("median").alias("median"), F.expr("percentile(abs(insert_size - median), 0.5, n)").alias("mad"), F.min("insert_size").alias("smallest"), F.max("insert_size").alias("largest"))
    mean = F.try_divide("_x", "pairs")
    spread = F.sqrt(F.try_divide(F.col("_xx") - F.col("_x") * mean, F.col("pairs") - 1))
    return rows.select("pairs", round6(mean).alias("mean"), round6(spread).alias("deviation"), "median", "mad", "smallest", "largest")
