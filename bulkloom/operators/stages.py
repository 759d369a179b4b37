"""Stage logs as tables: what is done, what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["program", "sample", "chromosome"]


def completed(log: DataFrame) -> DataFrame:
    """The distinct stages that have a COMPLETED line."""
    return log.where(F.col("status") == "COMPLETED").select(*KEYS).distinct()


def pending(work: DataFrame, log: DataFrame) -> DataFrame:
    """Stages of the work list without a COMPLETED line."""
    return work.join(completed(log), KEYS, "left_anti")


def chosen_partitions(table: DataFrame, key: str, chosen: DataFrame) -> DataFrame:
    """Rows of a table partitioned by key whose key is in chosen(key, ...).

    chosen should be a filtered scan: its keys then prune the table's folders at run time, before any file is opened.
    """
    return table.join(F.broadcast(chosen.select(key).distinct()), key, "left_semi")  # a row per partition at most


def work_list(programs: DataFrame, samples: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """Every program for every sample and chromosome: the run plan itself, a product by definition."""
    return programs.select("program").distinct().crossJoin(samples.select("sample").distinct()).crossJoin(chromosomes.select("chromosome").distinct())
