"""Bookkeeping of a pangenome: unmapped reads out, new contigs in, one version per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import effect_struct
from ..operators.contigs import append_version, long_contigs, rename_scaffolds
from ..operators.reads import name_sort, unmapped_pairs
from ..sources.sinks import write_fastq_pair


def export_unmapped(reads: DataFrame, path1: str, path2: str) -> None:
    write_fastq_pair(name_sort(unmapped_pairs(reads)), path1, path2)


def add_sample(reference: DataFrame, assembled: DataFrame, least: int = 200) -> DataFrame:
    """The reference's next version: with the sample's long contigs, renamed, at its end."""
    return append_version(reference, rename_scaffolds(long_contigs(assembled, least)))


def annotated_table(effects: DataFrame) -> DataFrame:
    """The effect table with EFF split into eleven columns at its end."""
    names = ("SNPEFF_EFFECT", "SNPEff_IMPACT", "SNPEFF_FUNCTIONAL_CLASS", "SNPEFF_CODON_CHANGE", "SNPEFF_AMINO_ACID_CHANGE", "SNPEFF_GENE_NAME", "SNPEFF_TRANSCRIPT_BIOTYPE", "SNPEFF_GENE_CODING", "SNPEFF_TRANSCRIPT_ID", "ERRORS", "WARNINGS")
    split = effects.withColumn("_eff", effect_struct(F.col("EFF")))
    fields = split.schema["_eff"].dataType.names
    return split.select(*(F.col(f"`{c}`") for c in effects.columns if c != "EFF"), *(F.col(f"_eff.{f}").alias(n) for f, n in zip(fields, names, strict=True)))
