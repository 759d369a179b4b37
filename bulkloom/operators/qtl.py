"""Chart series and QTL intervals from window means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: statistic, its column, the prefix of its thresholds, whether it has lower ones; in the order of the tests.
TWO_BULK_SERIES = (("ΔSNP-index", "dsi", "dsi", True), ("G-statistic", "gs", "gs", False), ("High-SNP-index", "high_si", "hb", True), ("Low-SNP-index", "low_si", "lb", True))
ONE_BULK_SERIES = (("SNP-index", "si", "b", True),)


def series(windows: DataFrame, kinds=TWO_BULK_SERIES) -> DataFrame:
    """(chrom, type, pos, statistic, value, p99, p95, p99_low, p95_low), one row per window and statistic."""
    parts = []
    for name, column, p, lower in kinds:
        low = [F.col(f"{p}_m_{k}") if lower else F.lit(None).cast("double") for k in ("p99", "p95")]
        parts.append(F.struct(F.lit(name).alias("statistic"), F.col(column).alias("value"), F.col(f"{p}_p99").alias("p99"), F.col(f"{p}_p95").alias("p95"), low[0].alias("p99_low"), low[1].alias("p95_low")))
    return windows.select("chrom", "type", F.floor("centre").cast("long").alias("pos"), F.explode(F.array(*parts)).alias("s")).select("chrom", "type", "pos", "s.*")


def tests(kinds=TWO_BULK_SERIES) -> list[tuple[int, str, str, str, int]]:
    """(order, statistic, threshold column, label, sign) of each test; sign -1 turns valleys into peaks."""
    out = []
    for name, _, _, lower in kinds:
        out += [(name, "p99", "99per (peak)", 1), (name, "p95", "95per (peak)", 1)]
        out += [(name, "p99_low", "99per (valley)", -1), (name, "p95_low", "95per (valley)", -1)] if lower else []
    return [(i, *t) for i, t in enumerate(out)]


def call_qtl(points: DataFrame, kinds=TWO_BULK_SERIES) -> DataFrame:
    """(chrom, type, qtl_start, qtl_end, peak, statistic, threshold, test_order): at most one interval per contig and test.

    The peak is the highest point beyond the threshold, the first of equals. Crossings are points where the curve has
    strictly changed sides since the point before. There must be two at least on the contig; the interval runs from the
    last crossing before the peak to the first after it, and one at the peak counts for neither. All tests run at once
    over the long table, each contig and test being one window partition.
    """
    of_statistic = lambda own: F.array(*(F.struct(F.lit(order).alias("o"), F.lit(label).alias("label"), F.lit(sign).alias("sign"), F.col(limit).alias("limit")) for order, name, limit, label, sign in tests(kinds) if name == own))
    own = F.lit(None)
    for name in reversed([k[0] for k in kinds]):  # a point meets the tests of its own statistic only
        own = F.when(F.col("statistic") == name, of_statistic(name)).otherwise(own)
    rows = points.withColumn("t", F.explode(own)).where(F.col("t.limit").isNotNull())
    rows = rows.select("chrom", "type", "pos", "statistic", F.col("t.o").alias("test_order"), F.col("t.label").alias("threshold"), F.col("t.sign").alias("sign"), (F.col("t.sign") * F.col("value")).alias("y"), (F.col("t.sign") * F.col("t.limit")).alias("h"))
    key = ["chrom", "type", "test_order"]
    by_pos, whole = W.partitionBy(*key).orderBy("pos"), W.partitionBy(*key)
    rows = rows.withColumns({"i": F.row_number().over(by_pos), "y0": F.lag("y").over(by_pos), "h0": F.lag("h").over(by_pos)})
    crosses = ((F.col("y0") < F.col("h0")) & (F.col("y") > F.col("h"))) | ((F.col("y0") > F.col("h0")) & (F.col("y") < F.col("h")))
    rows = rows.withColumn("crosses", F.coalesce(crosses, F.lit(False)))
    rows = rows.withColumn("top", F.max(F.when(F.col("y") > F.col("h"), F.struct(F.col("y"), (-F.col("i")).alias("i")))).over(whole))
    at = -F.col("top.i")
    found = rows.groupBy(*key, "statistic", "threshold").agg(
        F.max(F.when(F.col("crosses") & (F.col("i") < at), F.col("pos"))).alias("qtl_start"),
        F.min(F.when(F.col("crosses") & (F.col("i") > at), F.col("pos"))).alias("qtl_end"),
        (F.max("top.y") * F.max("sign")).alias("peak"),
        F.count_if("crosses").alias("n"),
    )
    found = found.where((F.col("n") >= 2) & F.col("qtl_start").isNotNull() & F.col("qtl_end").isNotNull())
    return found.select("chrom", "type", "qtl_start", "qtl_end", "peak", "statistic", "threshold", "test_order")
