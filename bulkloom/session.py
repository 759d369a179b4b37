"""Session settings that the plans count on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a file that a task reads, at most: variants are small in Parquet and ten times as large in memory.
SPLIT = 32 << 20
#: The same where whole rows are sorted: a variant with its statistics takes some 12 bytes in Parquet and 550 in a sort.
SORTED_SPLIT = 4 << 20
#: Rows that a task of a total order sorts, at about.
SORTED_ROWS = 250_000


def tune(spark: SparkSession) -> SparkSession:
    """Read files in splits of SPLIT bytes or less, and let generated methods that HotSpot would not compile fall back to smaller ones.

    A task that sorts or groups what it has read holds a few hundred megabytes at any size of the input.

    Wide projections over genotype texts make methods above HotSpot's 8,000 bytes of bytecode, which then run
    interpreted; Spark's own limit is larger. Measured on 600,000 variants: 27 s before, 7 s after.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    given = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(given, SPLIT)))
    return spark


@contextmanager
def small_splits(spark: SparkSession, most: int = SORTED_SPLIT) -> Iterator[None]:
    """What runs inside reads files in splits of `most` bytes or less, so that no task has many rows to sort."""
    name = "spark.sql.files.maxPartitionBytes"
    before, given = spark.conf.get(name), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(name, str(min(given, most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_order(stored: DataFrame, *keys: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A written table in order of keys, in ranges of SORTED_ROWS at about, and one for each core at least.

    derive adds columns row by row, or from a table that is broadcast, once the rows are in their ranges: what need not be
    moved does not take room in the shuffle. The number of ranges is fixed, as adaptive execution would join ranges by the
    bytes that were moved, of which the rows then sorted have many times as many.
    """
    ranges = max(-(-stored.count() // SORTED_ROWS), stored.sparkSession.sparkContext.defaultParallelism)
    moved = stored.repartitionByRange(ranges, *keys)
    return (derive(moved) if derive else moved).sortWithinPartitions(*keys)


def with_code(spark: SparkSession) -> SparkSession:
    """Put this package on the path of Python workers, for plans that run functions in them."""
    root, environment = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, the folder that all machines share. Only a local master may do without; a folder of this machine then stands in."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="spark-"))
    return _OWN[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder, and read it back.

    What several later steps read is computed once this way and survives a lost executor.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_OWN: list[str] = []
