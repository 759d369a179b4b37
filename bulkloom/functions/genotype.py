"""Genotypes, depths and effect texts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "./."
EFFECT_FIELDS = ("impact", "functional_class", "codon_change", "amino_acid_change", "gene_name", "transcript_biotype", "gene_coding", "transcript_id", "errors", "warnings")


def unphased(gt: Column) -> Column:
    return F.translate(gt, "|", "/")


def whole(text: Column) -> Column:
    """The text as a whole number, null where it is none.

    A text without a digit is not cast: a cast that fails makes an exception within Spark, which takes 17 microseconds, and
    missing fields are frequent.
    """
    return F.when(_has_digit(text), text.try_cast("int"))


def _has_digit(text: Column) -> Column:
    return text.between("0", ":") | text.rlike("[0-9]")  # the first holds where one comes first, and is cheaper


def lenient_int(text: Column) -> Column:
    """The text as a whole number, 0 where it is none."""
    return F.coalesce(whole(text), F.lit(0))


def lenient_depths(text: Column) -> Column:
    """`ref,alt` as an array of whole numbers; bad parts are null, and count as 0 where they are used.

    One cast of the whole array, as functions over its elements would keep the stage out of generated code; none for a text
    without a digit.
    """
    parts = F.split(text, ",")
    return F.when(_has_digit(text), parts.try_cast("array<int>")).otherwise(F.array_repeat(F.lit(None).cast("int"), F.size(parts)))


def depth_at(ad: Column, place: int) -> Column:
    return F.coalesce(F.get(ad, place), F.lit(0))


def is_called(gt: Column) -> Column:
    return gt != MISSING


def is_homozygous(gt: Column) -> Column:
    """Two alleles, both the same."""
    first = F.substring_index(gt, "/", 1)
    return gt == F.concat(first, F.lit("/"), first)


def is_biallelic(ad: Column) -> Column:
    return F.size(ad) == 2


def other_allele_depth(ref: Column, low_parent_gt: Column, ad: Column) -> tuple[Column, Column]:
    """(depth of the allele that the low parent lacks, depth of its own), by the low parent's first allele."""
    carries_ref = ref == F.get(F.split(low_parent_gt, "/"), 0)
    ref_depth, alt_depth = depth_at(ad, 0), depth_at(ad, 1)
    return F.when(carries_ref, alt_depth).otherwise(ref_depth), F.when(carries_ref, ref_depth).otherwise(alt_depth)


def variant_type(ref: Column, alt: Column) -> Column:
    """SNP: all alleles one base; MNP: all as long as the reference; INDEL: none as long; otherwise MIXED.

    One ALT, the most frequent form, does without functions over elements.
    """
    alts, one, equal = F.split(alt, ","), ~F.contains(alt, F.lit(",")), F.length(ref) == F.length(alt)
    single = F.when(one & equal & (F.length(ref) == 1), "SNP").when(one & equal, "MNP").when(one & ~equal, "INDEL")
    same = F.forall(alts, lambda a: F.length(a) == F.length(ref))
    several = F.when((F.length(ref) == 1) & same, "SNP").when(same, "MNP").when(F.forall(alts, lambda a: F.length(a) != F.length(ref)), "INDEL").otherwise("MIXED")
    return F.coalesce(single, several)


def failed_filters(rules: tuple[tuple[str, Column], ...]) -> Column:
    """Names of the rules that fire; a rule over a missing annotation does not."""
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in rules)))


def effect_struct(eff: Column) -> Column:
    """The first effect of an annotation text: its name and the ten fields in its brackets; missing ones are empty."""
    inside = F.regexp_extract(eff, r"\(([^)]*)\)", 1)
    parts = F.split(inside, r"\|")
    name = F.trim(F.regexp_extract(eff, r"^([^(]+)", 1))
    return F.struct(name.alias("effect"), *(F.trim(F.coalesce(F.get(parts, i), F.lit(""))).alias(field) for i, field in enumerate(EFFECT_FIELDS)))


def partition_key(contig: Column) -> Column:
    """A contig name that is safe as a folder name."""
    return F.replace(contig, F.lit("."), F.lit("_"))
