"""Means over sliding windows of positions, per contig and variant type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import micros

#: Keys whose limits are broadcast to the rows, at most.
MAX_LIMITS = 200_000
#: Steps of a contig that a task takes together, at least.
SEGMENT = 4096


def _bin(step: int):
    return F.floor(F.col("pos") / step)


def _means(summed: DataFrame, columns: list[str], window: int, step: int) -> DataFrame:
    centre = (F.col("k") * step + window / 2).cast("double")
    return summed.select("chrom", "type", centre.alias("centre"), "n", *((F.round(F.try_divide(F.col(c).cast("double"), F.col("n"))) / 1e6).alias(c) for c in columns))


def step_sums(stats: DataFrame, columns: list[str], step: int, *more: str) -> DataFrame:
    """(chrom, type, k, *more, n, sums of columns in whole micros) of the rows in each step k; a missing value counts as 0."""
    return stats.groupBy("chrom", "type", _bin(step).alias("k"), *more).agg(F.count("*").alias("n"), *_sums(columns))


def _sums(columns: list[str]) -> list:
    return [F.coalesce(F.sum(micros(F.col(c))), F.lit(0)).alias(c) for c in columns]


def are_few(limits: DataFrame) -> bool:
    """Whether limits can be broadcast to the rows."""
    return limits.limit(MAX_LIMITS + 1).count() <= MAX_LIMITS


def weighted_step_sums(stats: DataFrame, columns: list[str], step: int, keys: list[str], limits: DataFrame, limit_columns: list[str]) -> DataFrame:
    """The same with columns that depend on the keys alone, from limits(*keys, *limit_columns).

    Up to MAX_LIMITS limits are broadcast to the rows, which are then summed by step alone: a task holds a group for each step,
    not one for each step and key. For more, rows are counted by step and keys before the join, and each limit is
    weighted by its count, so that the join meets counts, never rows.
    """
    if are_few(limits):
        return step_sums(stats.join(F.broadcast(limits), keys), [*columns, *limit_columns], step)
    counted = step_sums(stats, columns, step, *keys)
    each = counted.join(limits, keys)
    weighted = [F.coalesce(F.sum(F.col("n") * micros(F.col(c))), F.lit(0)).alias(c) for c in limit_columns]
    return each.groupBy("chrom", "type", "k").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in columns), *weighted)


def window_means(stats: DataFrame, columns: list[str], window: int = 2_000_000, step: int = 10_000) -> DataFrame:
    """(chrom, type, centre, n, means of columns) over [s, s + window) for s = 0, step, 2 step, ... up to the last position.

    Values carry six decimals and are summed as whole micros, so results don't depend on the order of rows; a missing
    value counts as 0. If the step divides the window, rows are first summed per step, with a partial sum in each task.
    Otherwise rows go to each of their windows. Windows without rows are left out.
    """
    if window % step:
        low = F.greatest(F.lit(0), F.floor((F.col("pos") - window) / step) + 1)
        each = stats.withColumn("k", F.explode(F.sequence(low, _bin(step))))
        return _means(each.groupBy("chrom", "type", "k").agg(F.count("*").alias("n"), *_sums(columns)), columns, window, step)
    return means_of_steps(step_sums(stats, columns, step), columns, window, step)


def means_of_steps(bins: DataFrame, columns: list[str], window: int, step: int) -> DataFrame:
    """Window means from sums per step, where the step divides the window.

    A contig is cut into segments of steps; a step also goes to the segment before where windows that start there reach it,
    so no task needs a whole contig. Within a segment, steps without rows are filled in, as windows may start there, and
    a window's sum is the difference of two running sums, whatever the window holds.
    """
    last, size = window // step - 1, max(SEGMENT, window // step)
    own = F.floor(F.col("k") / size)
    bins = bins.withColumn("_s", F.explode(F.when((own > 0) & (F.col("k") - own * size < last), F.array(own, own - 1)).otherwise(F.array(own))))
    whole = W.partitionBy("chrom", "type", "_s")
    by_step, names = whole.orderBy("k"), ["n", *columns]
    # each bin stands for its own step and the empty ones up to the next bin, the first also for those before it
    filled = bins.withColumns({"_next": F.coalesce(F.lead("k").over(by_step), F.col("k") + 1), "_from": F.when(F.lag("k").over(by_step).isNull(), F.col("_s") * size).otherwise(F.col("k"))})
    filled = filled.withColumn("_k", F.explode(F.sequence(F.least("_from", "k"), F.col("_next") - 1)))
    dense = filled.select("chrom", "type", "_s", F.col("_k").alias("k"), *(F.when(F.col("_k") == F.col("k"), F.col(c)).otherwise(F.lit(0)).alias(c) for c in names))
    up_to = by_step.rowsBetween(W.unboundedPreceding, 0)
    run = dense.withColumns({f"_{c}": F.sum(c).over(up_to) for c in names})
    sliding = run.select("chrom", "type", "k", "_s", *((F.coalesce(F.lead(f"_{c}", last).over(by_step), F.sum(c).over(whole)) - F.col(f"_{c}") + F.col(c)).alias(c) for c in names))
    return _means(sliding.where((F.col("n") > 0) & (F.col("k") < (F.col("_s") + 1) * size)), columns, window, step)
