"""Statistics of allele counts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round6(x: Column) -> Column:
    """Six decimals, half away from zero, by scaling: what sums of micros rely on."""
    return F.round(x * 1e6) / 1e6


def micros(x: Column) -> Column:
    """A six-decimal value as a whole number, so that sums don't depend on the order of rows."""
    return F.round(x * 1e6).cast("long")


def snp_index(alt: Column, depth: Column) -> Column:
    """Share of the counted allele in the depth; null without depth."""
    return round6(F.try_divide(alt.cast("double"), depth.cast("double")))


def g_statistic(a1: Column, b1: Column, a2: Column, b2: Column) -> Column:
    """G of the table ((a1, b1), (a2, b2)): twice the sum of O ln(O / E) over cells with counts; 0 if a row is empty."""
    n1, n2 = a1 + b1, a2 + b2
    p = F.try_divide((a1 + a2).cast("double"), (n1 + n2).cast("double"))

    def cell(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.ln(F.try_divide(count.cast("double"), expected))).otherwise(0.0)

    total = cell(a1, n1 * p) + cell(b1, n1 * (1 - p)) + cell(a2, n2 * p) + cell(b2, n2 * (1 - p))
    return F.when((n1 == 0) | (n2 == 0), 0.0).otherwise(2 * total)
