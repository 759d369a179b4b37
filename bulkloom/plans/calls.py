"""Call-set post-processing: raw calls of one or more files to one filtered call set in coordinate order, contig by contig where a run is to resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.genotype import partition_key
from ..operators.callsets import coordinate_sort, filtered_calls
from ..operators.stages import chosen_partitions, pending
from ..session import materialise
from ..sources.sinks import append_stage_log
from ..sources.text import read_stage_log
from ..sources.variants import read_calls

TOOL, PROGRAM, SAMPLE = "VARIANT CALLING", "PostProcess", "all"


def post_process(calls: DataFrame) -> DataFrame:
    """Types, hard filters of SNPs and INDELs, and their merge, in one pass over all contigs; in coordinate order."""
    return coordinate_sort(filtered_calls(calls))


def run_calls(spark: SparkSession, path, out: str, log: str | None = None, **options) -> DataFrame:
    """Read VCF files, post-process their calls and write them with a folder per contig, sorted by position; returns what was written.

    With a log, the raw calls are laid out below `out` once, and contigs that the log has as completed are not read again.
    """
    if log is not None:
        raw = f"{out}/raw"
        append(spark, log, [("Layout", "STARTED")])
        if not read_stage_log(spark, log).where("program = 'Layout' AND status = 'COMPLETED'").limit(1).count():
            lay_out(read_calls(spark, path), raw)
            append(spark, log, [("Layout", "COMPLETED")])
        return resume_calls(spark, raw, f"{out}/filtered", log, **options)
    calls = filtered_calls(read_calls(spark, path)).withColumn("contig", partition_key(F.col("chrom")))
    calls.repartitionByRange("contig", "pos").sortWithinPartitions("contig", "pos").write.mode("overwrite").partitionBy("contig").parquet(out)
    return spark.read.parquet(out)


def lay_out(calls: DataFrame, path: str) -> None:
    """Write calls with a folder per contig, many tasks to a contig that is long."""
    calls.withColumn("contig", partition_key(F.col("chrom"))).repartitionByRange("contig", "pos").write.mode("overwrite").partitionBy("contig").parquet(path)


def append(spark: SparkSession, log: str, lines: list[tuple[str, str]], program: str | None = None) -> None:
    """Log lines now: (program, status) of the whole run, or with a program (contig, status) of each contig."""
    rows = [(program or a, "all" if program is None else a, status) for a, status in lines]
    df = spark.createDataFrame(rows, "program string, chromosome string, status string")
    append_stage_log(df.select(F.current_timestamp().alias("time"), F.lit(TOOL).alias("tool"), "program", F.lit(SAMPLE).alias("sample"), "chromosome", "status", F.lit("").alias("cmd")), log)


def resume_calls(spark: SparkSession, laid_out: str, out: str, log: str, batch: int = 64, rounds: int | None = None) -> DataFrame:
    """Post-process the contigs of a laid-out call table that the log hasn't as completed; returns all that is written.

    A contig is a unit. Each round takes `batch` pending ones: their folders alone are read (the list prunes the scan at run time),
    their output replaces what a broken run may have left of them, and then they are logged as completed. A run may be
    stopped at any time, or after so many rounds; the next one does what is left. Contigs that lose all calls to the
    filters have no folder but are completed too. The lists hold a row per contig.
    """
    table = spark.read.parquet(laid_out)
    contigs = table.select(F.lit(PROGRAM).alias("program"), F.lit(SAMPLE).alias("sample"), F.col("contig").cast("string").alias("chromosome")).distinct()
    plan = materialise(contigs, "contigs")
    append(spark, log, [("Resume", "STARTED")])
    # the output exists from the start, so that a run without pending or passing calls returns an empty table
    filtered_calls(table).limit(0).write.mode("append").partitionBy("contig").parquet(out)
    done = 0
    while rounds is None or done < rounds:
        left = pending(plan, read_stage_log(spark, log))
        units = materialise(left.orderBy("chromosome").limit(batch).select(F.col("chromosome").alias("contig"), F.lit("PENDING").alias("status")), "pending")
        names = [r["contig"] for r in units.collect()]  # at most `batch`
        if not names:
            break
        append(spark, log, [(c, "STARTED") for c in names], PROGRAM)
        calls = filtered_calls(chosen_partitions(table, "contig", units.where("status = 'PENDING'")))
        sorted_ = calls.repartitionByRange("contig", "pos").sortWithinPartitions("contig", "pos")
        sorted_.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("contig").parquet(out)
        append(spark, log, [(c, "COMPLETED") for c in names], PROGRAM)
        done += 1
    return spark.read.schema(table.schema).parquet(out)
