"""Bulk-segregant runs: two bulks with or without parents, or one bulk with parents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bsa_stats import add_limits, one_bulk_limits, one_bulk_statistics, two_bulk_limits, two_bulk_statistics
from ..operators.filters import filter_design
from ..operators.null_model import ONE_BULK_LIMITS, TWO_BULK_LIMITS, null_frequency
from ..operators.qtl import ONE_BULK_SERIES, TWO_BULK_SERIES, call_qtl, series
from ..operators.windows import are_few, means_of_steps, weighted_step_sums, window_means
from ..session import in_order, materialise, small_splits, tune
from ..sources.sinks import qtl_table, statistics_table, write_series, write_tsv
from ..sources.variants import assign_roles

TWO_BULK_VALUES = ["high_si", "low_si", "dsi", "gs", *TWO_BULK_LIMITS]
ONE_BULK_VALUES = ["si", *ONE_BULK_LIMITS]


@dataclass
class BsaResult:
    stats: DataFrame
    windows: DataFrame
    series: DataFrame
    qtl: DataFrame
    #: Columns of stats that `derive` gives to its other columns; none where thresholds are too many for a broadcast.
    derived: list[str]
    derive: Callable[[DataFrame], DataFrame] | None


def analyse(variants: DataFrame, design: str, window: int = 2_000_000, step: int = 10_000, population: str = "F2", min_depth: dict[str, int] | None = None, detail: bool = True) -> BsaResult:
    """The tables of a run over canonical variants; design as in filters.DESIGNS.

    The filtered variants with their statistics are written once: the distinct depth pairs, the threshold join and
    the windows all read them, and the input is scanned no more. The windows' rows are counted by step and depths before
    they meet the thresholds, and windows are written once, as series and intervals read them too. Without detail, what is
    written of a variant is its place, type, depths and statistics; its genotypes and other columns are not read further.
    """
    frequency = null_frequency(population)
    rows = filter_design(variants, design, window, step, min_depth)
    if design == "one_bulk":
        values, own, keys, kinds = ONE_BULK_VALUES, ["si"], ["b_dp"], ONE_BULK_SERIES
        statistics = one_bulk_statistics
    else:
        values, own, keys, kinds = TWO_BULK_VALUES, ["high_si", "low_si", "dsi", "gs"], ["hb_dp", "lb_dp"], TWO_BULK_SERIES
        statistics = partial(two_bulk_statistics, with_parents=design == "two_bulk")
    stats = statistics(rows)
    stats = materialise(stats if detail else stats.select("chrom", "pos", "type", *keys, *own), "stats")
    if design == "one_bulk":
        limits = one_bulk_limits(stats, frequency)
    else:
        limits = two_bulk_limits(stats, frequency, frequency)
    full, typed = add_limits(stats, limits, keys), stats.where(stats["type"].isin("SNP", "INDEL"))
    if window % step:
        windows = window_means(add_limits(typed, limits, keys), values, window, step)
    else:
        windows = means_of_steps(weighted_step_sums(typed, own, step, keys, limits, [v for v in values if v not in own]), values, window, step)
    windows = materialise(windows, "windows")
    points = series(windows, kinds)
    if not (detail and are_few(limits)):
        return BsaResult(full, windows, points, call_qtl(points, kinds), [], None)
    return BsaResult(full, windows, points, call_qtl(points, kinds), values, lambda rows: add_limits(statistics(rows), F.broadcast(limits), keys))


def choose_design(high_parent=None, low_parent=None, high_bulk=None, low_bulk=None) -> str:
    """Two bulks and both parents, two bulks alone, or one bulk and both parents; anything else is an error."""
    given = tuple(bool(x) for x in (high_parent, low_parent, high_bulk, low_bulk))
    designs = {(True, True, True, True): "two_bulk", (False, False, True, True): "two_bulk_only", (True, True, True, False): "one_bulk", (True, True, False, True): "one_bulk"}
    if given not in designs:
        raise ValueError("give two bulks, with both parents or none, or one bulk with both parents")
    return designs[given]


def run_bsa(wide: DataFrame, out: str, high_parent=None, low_parent=None, high_bulk=None, low_bulk=None, compression: str | None = None, **options) -> str:
    """Analyse a wide variant table and write statistics, windows, series and QTL below `out`; returns the design.

    Statistics and windows are written once and read back, so that the later tables don't recompute them; both are
    in order of contig and position. Writing by contig and the total order both sort whole rows: the tasks that do so read
    small splits and get ranges of a bounded number of rows, so what a task holds does not grow with the table.
    Statistics and thresholds are not moved for the order, as they follow from a row's calls: they are added in its range.

    compression: a codec such as gzip for the text of the statistics, some 210 bytes a variant, the largest of a run's tables.
    """
    design = choose_design(high_parent, low_parent, high_bulk, low_bulk)
    roles = {"high_parent": high_parent, "low_parent": low_parent, "high_bulk": high_bulk, "low_bulk": low_bulk}
    if design == "one_bulk":
        roles = {"high_parent": high_parent, "low_parent": low_parent, "bulk": high_bulk or low_bulk}
    roles = {k: v for k, v in roles.items() if v}
    spark, kinds = tune(wide.sparkSession), ONE_BULK_SERIES if design == "one_bulk" else TWO_BULK_SERIES
    result = analyse(assign_roles(wide, **roles), design, **options)
    with small_splits(spark):
        result.stats.write.mode("overwrite").partitionBy("chrom").parquet(f"{out}/stats")
        stats = spark.read.schema(result.stats.schema).parquet(f"{out}/stats")
        write_tsv(statistics_table(in_order(stats.drop(*result.derived), "chrom", "pos", derive=result.derive), **roles), f"{out}/statistics.tsv", compression)
    in_order(result.windows, "chrom", "type", "centre").write.mode("overwrite").parquet(f"{out}/windows")
    points = series(spark.read.parquet(f"{out}/windows"), kinds)
    write_series(points, f"{out}/series")
    for kind in ("SNP", "INDEL"):
        write_tsv(qtl_table(call_qtl(points.where(points["type"] == kind), kinds)), f"{out}/qtl_{kind}.tsv")
    return design
