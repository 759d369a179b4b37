"""Null distributions of the statistics, exact instead of simulated, and their quantiles per depth or depth pair."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import round6
from ..session import materialise, with_code

#: Allele frequency of a bulk under no linkage: the mean dose of the population's genotypes.
NULL_AF = {"F2": 0.5, "RIL": 0.5, "BC": 0.25}
#: Suffix and quantile of each threshold: two-sided 1 % and 10 %.
QUANTILES = (("p99", 0.995), ("p95", 0.95), ("m_p99", 0.005), ("m_p95", 0.05))
#: Float dust must not move a quantile of a discrete distribution.
DUST = 1e-9


def null_frequency(population: str) -> float:
    if population not in NULL_AF:
        raise ValueError(f"population {population!r} is none of {sorted(NULL_AF)}")
    return NULL_AF[population]


def binomial(depths: DataFrame, frequency: float) -> DataFrame:
    """(n, k, si, w) for depths(n): the chance w of k counts of n, with the index si = k / n.

    Log factorials are a running sum over k, as there is no log-gamma among the built-in functions.
    """
    cells = depths.select(F.col("n").cast("int")).where("n >= 1").select("n", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k"))
    step = F.when(F.col("k") == 0, 0.0).otherwise(F.ln((F.col("n") - F.col("k") + 1).cast("double") / F.col("k")))
    ways = F.sum(step).over(W.partitionBy("n").orderBy("k").rowsBetween(W.unboundedPreceding, 0))
    log_w = ways + F.col("k") * math.log(frequency) + (F.col("n") - F.col("k")) * math.log(1 - frequency)
    return cells.select("n", "k", round6(F.col("k").cast("double") / F.col("n")).alias("si"), F.exp(log_w).alias("w"))


def _quantiles(weighted: DataFrame, keys: list[str], value: str = "value", weight: str = "w") -> DataFrame:
    """The least value of each key whose running share reaches each quantile, as columns p99, p95, m_p99, m_p95."""
    share = F.sum(weight).over(W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    run = weighted.withColumn("_share", share)
    return run.groupBy(*keys).agg(*(F.min(F.when(F.col("_share") >= q - DUST, F.col(value))).alias(name) for name, q in QUANTILES))


def one_bulk_thresholds(depths: DataFrame, frequency: float) -> DataFrame:
    """(n, p99, p95, m_p99, m_p95) of the SNP index for depths(n)."""
    return _quantiles(binomial(depths.select("n").distinct(), frequency), ["n"], "si")


class Bulk:
    """The outcomes of one depth: counts 0 to n, their chances, and their indices in millionths."""

    def __init__(self, n: int, frequency: float):
        k = np.arange(n + 1)
        ways = np.concatenate([[0.0], np.cumsum(np.log((n - k[1:] + 1) / k[1:]))])
        self.n, self.k = n, k
        self.chance = np.exp(ways + k * math.log(frequency) + (n - k) * math.log(1 - frequency))
        self.micros = np.floor(k / n * 1e6 + 0.5).astype(np.int64)
        #: chance of fewer than j counts
        self.below = np.concatenate([[0.0], np.cumsum(self.chance)])

    def index_quantile(self, share: float) -> int:
        return int(self.micros[np.searchsorted(self.below[1:], share - DUST)])


def difference_quantiles(high: Bulk, low: Bulk, shares: np.ndarray) -> np.ndarray:
    """The least difference of the indices, in millionths, whose share reaches each of shares.

    For a bound v, the pairs with s1 - s2 <= v form a staircase: the lower bulk's index must reach s1 - v, so a step of
    the bisection over v adds up one tail of its distribution for each outcome of the higher one.
    """
    least, most = np.full(shares.size, -1_000_000), np.full(shares.size, 1_000_000)
    while (least < most).any():
        v = (least + most) // 2
        tail = 1 - low.below[np.searchsorted(low.micros, high.micros - v[:, None])]
        reached = tail @ high.chance >= shares - DUST
        least, most = np.where(reached, least, v + 1), np.where(reached, v, most)
    return least


def g_quantiles(high: Bulk, low: Bulk, shares: np.ndarray) -> np.ndarray:
    """The least G, in millionths, whose share reaches each of shares.

    For one outcome of the higher bulk, G falls as the lower one's count rises to where both have the same index, and rises
    from there. So outcomes of G <= g are one stretch of counts for each outcome, whose two ends are found by bisection in
    both flanks at once, and g is found by bisection around that. No pair of outcomes is looked at for its own sake.
    """
    n, m, a = high.n, low.n, high.k
    x = np.arange(n + m + 1)
    xlogx = x * np.log(np.maximum(x, 1))
    own = xlogx[a] + xlogx[n - a] + xlogx[n + m] - xlogx[n] - xlogx[m]

    def micros(b: np.ndarray) -> np.ndarray:  # b: a count of the lower bulk for each outcome of the higher, along the last axis
        g = 2 * (own + xlogx[b] + xlogx[m - b] - xlogx[a + b] - xlogx[n + m - a - b])
        return np.floor(np.maximum(g, 0) * 1e6 + 0.5)

    ridge = a * m // n
    shape = (shares.size, a.size)
    least, most = np.zeros(shares.size), np.full(shares.size, max(micros(np.zeros(a.size, np.int64)).max(), micros(np.full(a.size, m)).max()))
    while (least < most).any():
        g = np.floor((least + most) / 2)[:, None]
        first, last = np.zeros(shape, np.int64), np.broadcast_to(ridge + 1, shape).copy()  # the left end lies in [0, ridge + 1]
        begin, end = np.broadcast_to(ridge + 1, shape).copy(), np.full(shape, m + 1)  # past the right end, in [ridge + 1, m + 1]
        while (first < last).any() or (begin < end).any():
            mid, far = (first + last) // 2, (begin + end) // 2
            left, right = micros(np.minimum(mid, m)) <= g, micros(np.minimum(far, m)) > g
            open_left, open_right = first < last, begin < end
            first, last = np.where(open_left & ~left, mid + 1, first), np.where(open_left & left, mid, last)
            begin, end = np.where(open_right & ~right, far + 1, begin), np.where(open_right & right, far, end)
        reached = (low.below[begin] - low.below[first]) @ high.chance >= shares - DUST
        least, most = np.where(reached, least, g[:, 0] + 1), np.where(reached, g[:, 0], most)
    return least


def two_bulk_thresholds(pairs: DataFrame, high_frequency: float, low_frequency: float) -> DataFrame:
    """Thresholds of both indices, their difference and G for distinct pairs(high_dp, low_dp) of depths of 1 or more.

    Quantiles of difference and G come from sweeps over the two distributions, in O((n + m) log) steps a pair instead of the
    (n + 1)(m + 1) outcomes of the grid. The distinct pairs are written once and dealt out over all cores.
    """
    spark = with_code(pairs.sparkSession)
    high_dp, low_dp = (F.col(c).cast("int").alias(c) for c in ("high_dp", "low_dp"))
    pairs = materialise(pairs.select(high_dp, low_dp).where("high_dp >= 1 AND low_dp >= 1").distinct(), "pairs")
    shares = np.array([q for _, q in QUANTILES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bulk = lru_cache(4096)(Bulk)
        for batch in batches:
            n, m = (batch.column(i).to_pylist() for i in (0, 1))
            rows = []
            for high, low in ((bulk(x, high_frequency), bulk(y, low_frequency)) for x, y in zip(n, m, strict=True)):
                rows.append([*(b.index_quantile(q) for b in (high, low) for q in shares), *difference_quantiles(high, low, shares), *g_quantiles(high, low, shares[:2])])
            values = np.array(rows, np.float64).reshape(-1, len(TWO_BULK_LIMITS)) / 1e6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(v) for v in values.T)], names=["high_dp", "low_dp", *TWO_BULK_LIMITS])

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    schema = "high_dp int, low_dp int, " + ", ".join(f"{c} double" for c in TWO_BULK_LIMITS)
    return pairs.repartition(tasks, "high_dp", "low_dp").mapInArrow(run, schema)


TWO_BULK_LIMITS = [f"{p}_{n}" for p in ("hb", "lb", "dsi") for n, _ in QUANTILES] + ["gs_p99", "gs_p95"]
ONE_BULK_LIMITS = [f"b_{n}" for n, _ in QUANTILES]
