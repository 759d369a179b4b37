"""Helpers that the training-data operators share: session set-up, written tables, bounded broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What every contract calls a word, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows an Arrow batch may hold; long texts make large rows, so the default of 10,000 is too many.
ARROW_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which all machines share. Only a local master may do without: a folder of this machine then stands in."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def prepare(spark: SparkSession) -> SparkSession:
    """Make the session ready: a checkpoint folder, small Arrow batches, this code on the workers' path."""
    sc = spark.sparkContext
    shared_folder(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
    return spark


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared checkpoint folder and read it back: computed once, safe if an executor is lost."""
    spark = prepare(df.sparkSession)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most max_rows rows, else df as it is, for a shuffled join.

    df should be a materialised table: its rows are counted here.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def stored(df: DataFrame) -> DataFrame:
    """df if it is a plain scan of files, whose rows come in the same order each time; else df written and read back.

    Operators that number rows in one pass and join by that number in another need this.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    plain = "FileScan" in plan and not any(x in plan for x in ("Exchange", "InMemoryTableScan", "Sample", "Scan ExistingRDD"))
    return df if plain else materialise(df, "stored")


def row_ordinal() -> Column:
    """A number for each row of a scan; see stored()."""
    return F.monotonically_increasing_id()


#: Numbers of rows that repeat are broadcast up to so many.
MAX_REPEATS = 1_000_000


def repeat_numbers(keys: DataFrame) -> DataFrame | None:
    """(_row, _nth) of keys(_ord, _key) whose key repeats: each gets a number of its own among its equals, 0, 1, ...; None if no key repeats.

    What a row gets depends on the scan, the numbers that a key's rows have do not: so hashes of key and number are the same
    for any splits of the files. Equals are numbered by scan task first, so a key with a third of all rows is many small groups.
    """
    again = materialise(keys.groupBy("_key").count().where("count > 1").select(F.col("_key").alias("_again")), "repeats")
    if not again.limit(1).count():
        return None
    part = F.shiftright("_ord", 33)
    mine = materialise(keys.join(broadcast_if_small(again, MAX_REPEATS), F.col("_key") == F.col("_again")).select("_key", "_ord", part.alias("_part")), "repeated")
    counts = mine.groupBy(F.col("_key").alias("_k"), F.col("_part").alias("_p")).count()
    before = F.coalesce(F.sum("count").over(W.partitionBy("_k").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row per scan task
    counts = counts.select("_k", "_p", before.alias("_before"))
    inside = mine.withColumn("_at", F.row_number().over(W.partitionBy("_key", "_part").orderBy("_ord")) - 1)
    out = inside.join(counts, (F.col("_key") == F.col("_k")) & (F.col("_part") == F.col("_p"))).select(F.col("_ord").alias("_row"), (F.col("_before") + F.col("_at")).alias("_nth"))
    return broadcast_if_small(materialise(out, "repeat-numbers"), MAX_REPEATS)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shield(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame, list[str]], DataFrame]]:
    """docs as the needed columns and one struct with all others, so that no name of the caller's meets an operator's own.

    The second value puts the columns back in their order, before those that the operator adds; columns of docs with
    an added name are left out. Names are compared without case, as Spark does.
    """
    own = {c.lower(): c for c in docs.columns if c.lower() in needed}
    extra = [c for c in docs.columns if c.lower() not in own]
    packed = [F.struct(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(extra))).alias("_extra")] if extra else []
    inner = docs.select(*(F.col(f"`{own[c]}`").alias(c) for c in needed if c in own), *packed)
    place = {c: F.col("_extra").getField(f"_{i}").alias(c) for i, c in enumerate(extra)} | {name: F.col(c).alias(name) for c, name in own.items()}

    def restore(out: DataFrame, added: list[str]) -> DataFrame:
        taken = {c.lower() for c in added}
        return out.select(*(place[c] for c in docs.columns if c.lower() not in taken), *added)

    return inner, restore
