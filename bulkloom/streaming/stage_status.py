"""Stages kept current while jobs append to their log: the completed ones as a stream, and completed and pending as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stages import KEYS, completed


def completed_stream(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """Completed stages of a streaming log, each once within the watermark; state older than that goes."""
    done = log.where(F.col("status") == "COMPLETED").select("time", *KEYS)
    return done.withWatermark("time", late).dropDuplicatesWithinWatermark(KEYS)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what the stream yields to a Parquet table and return when the input so far is worked off."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def completed_of(spark: SparkSession, log: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """The stages completed, as the stream found them: equal to the batch answer on the same files."""
    run_to_table(completed_stream(log), path, checkpoint)
    return spark.read.schema("time timestamp, program string, sample string, chromosome string").parquet(path).select(*KEYS)


_STATUS = "program string, sample string, chromosome string, done boolean, batch long"


def upsert_status(work: DataFrame, lines: DataFrame, batch: int, path: str) -> None:
    """Write the status of every stage of the work list after a batch of log lines: that of the batch before, and what these lines complete.

    Two folders take turns, so a batch reads what the one before has written and overwrites what the one before that wrote. A
    batch that comes again, as after a failure, reads the same and writes the same. The cost follows the work list and the
    batch, not the log's history.
    """
    spark = work.sparkSession
    before = work.select(*KEYS, F.lit(False).alias("done")) if batch == 0 else spark.read.schema(_STATUS).parquet(f"{path}/turn={(batch - 1) % 2}").select(*KEYS, "done")
    hit = completed(lines).withColumn("_hit", F.lit(True))
    match = [before[k].eqNullSafe(hit[k]) for k in KEYS]
    now = before.join(hit, match, "left").select(*(before[k] for k in KEYS), (F.col("done") | F.col("_hit").isNotNull()).alias("done"), F.lit(batch).cast("long").alias("batch"))
    now.write.mode("overwrite").parquet(f"{path}/turn={batch % 2}")


def keep_status(work: DataFrame, log: DataFrame, path: str, checkpoint: str) -> None:
    """Work off what has come to a streaming log and keep the table at path current; starts where the last call with this checkpoint ended."""
    q = log.writeStream.foreachBatch(lambda lines, batch: upsert_status(work, lines, batch, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def status(spark: SparkSession, path: str) -> DataFrame:
    """(program, sample, chromosome, done) after the last batch: the completed and the pending stages."""
    both = spark.read.schema(_STATUS + ", turn int").parquet(path)
    last = both.agg(F.max("batch").alias("last"))
    return both.join(F.broadcast(last), F.col("batch") == F.col("last")).select(*KEYS, "done")  # one row
