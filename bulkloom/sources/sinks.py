"""Writers of the result tables in their fixed column order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a packed text file, at most.
PACKED_ROWS = 500_000


def _six(name: str) -> Column:
    return F.format_string("%.6f", F.col(name))


def _role(prefix: str, sample: str) -> list[Column]:
    return [F.col(f"{prefix}_gt").alias(f"{sample}.GT"), F.array_join(f"{prefix}_ad", ",").alias(f"{sample}.AD"), F.col(f"{prefix}_dp").alias(f"{sample}.DP")]


def _limits(prefix: str, label: str, lower: bool = True) -> list[Column]:
    return [_six(f"{prefix}_{k}").alias(f"{label}_{k}") for k in ("p99", "p95", *(("m_p99", "m_p95") if lower else ()))]


def statistics_table(stats: DataFrame, **names: str) -> DataFrame:
    """The statistics as they are written: for high_bulk and low_bulk, with or without parents, or for one bulk with parents."""
    site = [F.col(c).alias(c.upper()) for c in ("chrom", "pos", "ref", "alt", "type")]
    parents = [*_role("lp", names["low_parent"]), *_role("hp", names["high_parent"])] if "high_parent" in names else []
    if "bulk" in names:
        b = names["bulk"]
        return stats.select(*site, *parents, *_role("b", b), _six("si").alias(f"{b}_SNP_INDEX"), *_limits("b", b))
    high, low = names["high_bulk"], names["low_bulk"]
    own = [_six("high_si").alias(f"{high}_SNP_INDEX"), _six("low_si").alias(f"{low}_SNP_INDEX"), _six("dsi").alias("DELTA_SNP_INDEX"), _six("gs").alias("G_STATISTIC")]
    return stats.select(*site, *parents, *_role("lb", low), *_role("hb", high), *own, *_limits("hb", high), *_limits("lb", low), *_limits("dsi", "dsi"), *_limits("gs", "gs", False))


def qtl_table(qtl: DataFrame) -> DataFrame:
    return qtl.orderBy("chrom", "test_order").select(F.col("chrom").alias("CHROM"), F.col("qtl_start").alias("QTLstart"), F.col("qtl_end").alias("QTLend"), F.col("peak").alias("PEAK"), F.col("statistic").alias("STATISTIC"), F.col("threshold").alias("THRESHOLD"))


def write_tsv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Text with a header in each file, packed if a codec is given. Readers can't cut a packed file, so such ones hold PACKED_ROWS at most."""
    writer = df.write.option("maxRecordsPerFile", PACKED_ROWS) if compression else df.write
    writer.csv(path, sep="\t", header=True, compression=compression)


def write_series(series: DataFrame, path: str) -> None:
    """Chart data, a folder per variant type and statistic."""
    series.write.partitionBy("type", "statistic").parquet(path)


def write_fasta(contigs: DataFrame, path: str) -> None:
    contigs.orderBy("contig_no").select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq")).write.text(path)


def write_fasta_chunks(contigs: DataFrame, chunks: DataFrame, path: str) -> None:
    """FASTA from contigs(contig_no, name) and chunks(contig_no, offset, chunk), dealt by ranges of contigs, so that each file holds whole ones.

    Readers leave out what stands before a file's first header, so a contig must not go on in the next file. Its chunks are
    sorted and written one after another; no row or group holds all of them.
    """
    heads = contigs.select("contig_no", F.lit(-1).cast("long").alias("offset"), F.concat(F.lit(">"), "name").alias("line"))
    heads.unionByName(chunks.select("contig_no", "offset", F.col("chunk").alias("line"))).repartitionByRange("contig_no").sortWithinPartitions("contig_no", "offset").select("line").write.text(path)


def append_stage_log(log: DataFrame, path: str) -> None:
    keys = [F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("time"), F.col("tool").alias("msg"), *(F.col(k).alias(k.upper()) for k in ("program", "sample", "chromosome", "status", "cmd"))]
    log.select(*keys).write.mode("append").json(path)


def fastq_lines(reads: DataFrame, mate: int) -> DataFrame:
    """One value of four lines per read of the mate (1 or 2), on its own strand, in name order."""
    flag = F.col("flag").bitwiseAND(F.lit(64 if mate == 1 else 128)) != 0
    back = F.col("flag").bitwiseAND(F.lit(16)) != 0
    seq = F.when(back, F.reverse(F.translate("seq", "ACGTacgt", "TGCAtgca"))).otherwise(F.col("seq"))
    qual = F.when(back, F.reverse("qual")).otherwise(F.col("qual"))
    return reads.where(flag).orderBy("qname").select(F.concat_ws("\n", F.concat(F.lit("@"), "qname", F.lit(f"/{mate}")), seq, F.lit("+"), qual).alias("value"))


def write_fastq_pair(reads: DataFrame, path1: str, path2: str) -> None:
    fastq_lines(reads, 1).write.text(path1)
    fastq_lines(reads, 2).write.text(path2)
