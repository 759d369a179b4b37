"""Statistics of each variant, with their thresholds by depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import depth_at, other_allele_depth
from ..functions.stats import g_statistic, round6, snp_index
from ..session import materialise
from .null_model import QUANTILES, one_bulk_thresholds, two_bulk_thresholds


def two_bulk_statistics(variants: DataFrame, with_parents: bool = True) -> DataFrame:
    """variants with high_si, low_si, dsi and gs. With parents, the allele that the low parent lacks is counted, else ALT."""
    counts = {}
    for p in ("hb", "lb"):
        counts[p] = other_allele_depth(F.col("ref"), F.col("lp_gt"), F.col(f"{p}_ad")) if with_parents else (depth_at(F.col(f"{p}_ad"), 1), depth_at(F.col(f"{p}_ad"), 0))
    (h, h0), (lo, lo0) = counts["hb"], counts["lb"]
    out = variants.withColumns({"high_si": snp_index(h, F.col("hb_dp")), "low_si": snp_index(lo, F.col("lb_dp")), "gs": round6(g_statistic(h0, h, lo0, lo))})
    return out.withColumn("dsi", round6(F.col("high_si") - F.col("low_si")))


def one_bulk_statistics(variants: DataFrame) -> DataFrame:
    count, _ = other_allele_depth(F.col("ref"), F.col("lp_gt"), F.col("b_ad"))
    return variants.withColumn("si", snp_index(count, F.col("b_dp")))


def two_bulk_limits(stats: DataFrame, high_frequency: float = 0.5, low_frequency: float = 0.5) -> DataFrame:
    """(hb_dp, lb_dp, thresholds), made and written once per distinct depth pair."""
    pairs = stats.select(F.col("hb_dp").alias("high_dp"), F.col("lb_dp").alias("low_dp"))
    return materialise(two_bulk_thresholds(pairs, high_frequency, low_frequency).withColumnsRenamed({"high_dp": "hb_dp", "low_dp": "lb_dp"}), "thresholds")


def one_bulk_limits(stats: DataFrame, frequency: float = 0.5) -> DataFrame:
    """(b_dp, thresholds), made and written once per distinct depth."""
    limits = one_bulk_thresholds(stats.select(F.col("b_dp").alias("n")), frequency)
    return materialise(limits.select(F.col("n").alias("b_dp"), *(F.col(n).alias(f"b_{n}") for n, _ in QUANTILES)), "thresholds")


def add_limits(stats: DataFrame, limits: DataFrame, keys: list[str]) -> DataFrame:
    """stats with the thresholds of its depths; Spark broadcasts them where their size allows."""
    added = [c for c in limits.columns if c not in keys]
    return stats.join(limits, keys).select(*stats.columns, *added)
